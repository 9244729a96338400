"""Layouts for the processing software the profiles are handed to."""

from pyspark.sql import functions as F

from fathomline.operators.layers import first_deepest

# Dbar to psi, and the layout's column names.
PSI_PER_DBAR = 1.45038
LAYOUT = {"temperature_C": "Tv2C", "salinity_psu": "Sal2", "oxygen_saturation_percent": "Sbeox2PS"}


def _projected(rows, profile, order, *more):
    return rows.select(profile, order, *[F.col(c).alias(a) for c, a in LAYOUT.items()],
                       (F.col("pressure_dbar") * PSI_PER_DBAR).alias("PrdE"), *more)


def _first_per_pressure(rows, keys, order):
    """One row per pressure, the first scan: plain aggregates, combined before the shuffle."""
    return rows.groupBy(*keys, "PrdE").agg(*[F.min_by(c, order).alias(c) for c in LAYOUT.values()])


def cast_halves(rows, profile="cast_id", order="scan"):
    """Add ``direction``: down before the first pressure maximum, up from it on.

    A cast whose upward half is a single row has no upward half.
    """
    turn = rows.groupBy(profile).agg(first_deepest("PrdE", order).alias("_turn"), F.max(order).alias("_end"))
    halves = rows.join(turn, profile).withColumn(
        "direction", F.when(F.col(order) < F.col("_turn"), "downward").otherwise("upward"))
    return halves.where((F.col("direction") == "downward") | (F.col("_end") > F.col("_turn"))).drop("_turn", "_end")


def a2ps_split(rows, profile="cast_id", order="scan"):
    """Downward and upward halves, one row per pressure, to be sorted by pressure on writing."""
    halves = cast_halves(_projected(rows, profile, order), profile, order)
    return _first_per_pressure(halves, [profile, "direction"], order)


def a2ps_whole(rows, profile="cast_id", order="scan"):
    """The whole cast, one row per pressure."""
    return _first_per_pressure(_projected(rows, profile, order), [profile], order)


def a2ps_clock(rows, profile="cast_id", order="scan", clock="timestamp"):
    """The whole cast with clock columns, every row, in scan order."""
    return _projected(rows, profile, order, F.date_format(clock, "HH:mm:ss").alias("hh:mm:ss"),
                      F.date_format(clock, "MM/dd/yyyy").alias("mm/dd/yyyy"))


def oxygen_warnings(layout, keys):
    """Profiles whose exported mean oxygen is negative."""
    return layout.groupBy(*keys).agg(F.avg("Sbeox2PS").alias("mean_oxygen")).where("mean_oxygen < 0")
