"""Campaign summaries: each is one grouped aggregate, combined before the shuffle."""

from pyspark.sql import functions as F

from fathomline import schema


def in_stations(rows, stations=None):
    """Rows of the named stations, or all of them."""
    return rows if stations is None else rows.where(F.col("Station").isin(list(stations)))


def in_station_range(rows, low=1, high=33):
    return rows.where(F.col("station_ODV").between(low, high))


def named_profiles(rows):
    return rows.where(F.col("profile_name").isNotNull())


def sheet_discrete(rows, stations=None, low=1, high=33):
    """Mixed layer depths and mean air PAR per profile, in station order."""
    picked = in_station_range(in_stations(rows, stations), low, high)
    return picked.groupBy("profile_name", "station_ODV").agg(
        *[F.avg(c).alias(f"avg_{c}") for c in ("mld_dens", "mld_temp", "PAR_avg_air")]).orderBy(
        "station_ODV", "profile_name")


def sheet_draft(rows, station="A"):
    """Temperature and density against depth for one station."""
    return in_stations(rows, [station]).groupBy("depth_m", "Station", "date").agg(
        F.avg("temperature_C").alias("avg_temperature_C"), F.avg("density_kg_m3").alias("avg_density_kg_m3"),
        F.sum("mld_dens").alias("sum_mld_dens"))


def sheet_draft_pressure(rows):
    """The same against pressure, all stations, profiles with a name."""
    return named_profiles(rows).groupBy("pressure_dbar", "date").agg(
        F.avg("temperature_C").alias("avg_temperature_C"), F.avg("density_kg_m3").alias("avg_density_kg_m3"),
        F.sum("mld_dens").alias("sum_mld_dens"))


def sheet_map(rows):
    """Greatest depth at each station position and time."""
    return rows.groupBy("Latitude", "Longitude", "datetime", "Station", "station_ODV").agg(
        F.max("depth_m").alias("max_depth_m"))


def long_form(rows, ids, measures, drop_missing=False):
    """``(ids, measure, value)``."""
    out = rows.unpivot(ids, measures, "measure", "value")
    return out.where(F.col("value").isNotNull()) if drop_missing else out


def sheet_measurement(rows, measures):
    """Chosen measures averaged by depth and station, in long form."""
    means = rows.groupBy("depth_m", "Station").agg(*[F.avg(c).alias(c) for c in measures])
    return long_form(means, ["depth_m", "Station"], list(measures))


def sheet_station(rows, station="AA", log_scale=False):
    """Oxygen and the two temperatures by depth for one station, in long form."""
    measures = ["oxygen_concentration_ml_per_L", "pot_temp_C", "temperature_C"]
    measures = [c for c in measures if c in rows.columns]
    means = in_stations(rows, [station]).groupBy("depth_m").agg(*[F.avg(c).alias(c) for c in measures])
    out = long_form(means, ["depth_m"], measures)
    return out.withColumn("log_value", F.when(F.col("value") > 0, F.log10("value"))) if log_scale else out


def measure_totals(rows, by=("Station",), measures=None):
    """Average and sum of every measure, and the row count, by any dimensions."""
    present = [c for c in (measures or schema.MEASURES) if c in rows.columns]
    aggregates = [f(c).alias(f"{n}_{c}") for c in present for n, f in (("avg", F.avg), ("sum", F.sum))]
    return rows.groupBy(*by).agg(F.count("*").alias("n_rows"), *aggregates)


def profile_long(rows, depth="depth_m", skip=("date", "time", "datetime", "timestamp")):
    """Every numeric column against depth: the data behind a profile plot."""
    leave = {depth.lower(), *[s.lower() for s in skip]}
    numeric = [c for c, t in rows.dtypes if t == "double" and c.lower() not in leave]
    ids = [c for c in ("cast_id", "scan") if c in rows.columns]
    return long_form(rows, [*ids, depth], numeric)


def pressure_series(rows, cast, clock="datetime"):
    """Clock and pressure of one cast, in time order."""
    return rows.where(F.col("cast_id") == cast).select(clock, "pressure_dbar").orderBy(clock)


def daily_groups(scans, cast="cast_id", order="scan", modified=None):
    """``(cast, ctd_type, cast_date)``: the day of a cast's first row.

    The first clock that is there: ``timestamp``, ``datetime``, ``date``, then the file's modification time (column
    ``modified``), then today.
    """
    choices = [F.min_by(F.col(c).cast("date"), order) for c in ("timestamp", "datetime", "date") if c in scans.columns]
    if modified:
        choices.append(F.max(F.col(modified).cast("date")))
    return scans.groupBy(cast, "ctd_type").agg(F.coalesce(*choices, F.current_date()).alias("cast_date"))
