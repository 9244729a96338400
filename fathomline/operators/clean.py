"""Removal of in-air scans, offsets taken from them, and the quality flags.

Statistics of a cast are plain aggregates (combined map-side) joined back to its rows, not a window over the cast:
however long one cast is, its rows stay spread over the tasks that read them. Only where every cast was measured to fit a
task (``size`` None) are they windows, which costs one shuffle for everything.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathomline import schema
from fathomline.operators.sequence import CHUNK, exact_median

# An air oxygen offset beyond this is a bad reading; pH outside this range is dropped.
MAX_OXYGEN_OFFSET = 50.0
PH_RANGE = (6.0, 9.0)

COND, PRES, OXY, PAR = ("conductivity_mS_per_m", "pressure_dbar", "oxygen_saturation_percent", "PAR_umol_m2_s")


def threshold(ctd_type=None, limit=None):
    """Conductivity that separates air from water; ``limit`` overrides it for all instruments."""
    if limit is not None:
        return F.lit(float(limit))
    kind = F.lower(F.col(ctd_type or "ctd_type"))
    return F.when(kind == "exo", schema.AIR_CONDUCTIVITY_EXO).otherwise(schema.AIR_CONDUCTIVITY)


def air_water_split(scans, limit=None):
    """Add ``medium``: 'air', 'water', or NULL when conductivity is missing or equals the threshold."""
    t = threshold(limit=limit)
    return scans.withColumn("medium", F.when(F.col(COND) < t, "air").when(F.col(COND) > t, "water"))


def air_offsets(scans, cast="cast_id", limit=None, size=CHUNK):
    """One row per cast that has air scans: count, pressure and oxygen offsets, mean PAR in air."""
    schema.require(scans, [cast, "ctd_type", COND, PRES, OXY])
    air = scans.where(F.col(COND) < threshold(limit=limit))
    par = F.avg(PAR) if PAR in scans.columns else F.lit(None).cast("double")
    counts = air.groupBy(cast).agg(F.count("*").alias("n_air"), par.alias("PAR_avg_air"))
    middles = exact_median(air, [cast], [PRES, OXY], size).withColumnsRenamed({PRES: "_pressure", OXY: "_oxygen"})
    raw = F.col("_oxygen") - 100.0
    return counts.join(middles, cast, "left").select(
        cast, "n_air", F.col("_pressure").alias("pressure_offset"),
        F.when(F.abs(raw) > MAX_OXYGEN_OFFSET, 0.0).otherwise(raw).alias("oxygen_offset"),
        (F.abs(raw) > MAX_OXYGEN_OFFSET).alias("bad_air_oxygen"), "PAR_avg_air")


def air_correct(scans, cast="cast_id", limit=None, offsets=None, size=CHUNK):
    """Water rows with corrected pressure and oxygen; casts without air rows come back as they are.

    ``_keep`` says whether a row survives; ``apply_keep`` turns it into the filter.
    """
    if size is None and offsets is None:
        rows = _with_offsets_in_place(scans, cast, limit)
    else:
        offsets = air_offsets(scans, cast, limit, size) if offsets is None else offsets
        rows = scans.join(offsets.select(cast, "n_air", "pressure_offset", "oxygen_offset", "PAR_avg_air"), cast, "left")
    has_air = F.col("n_air").isNotNull()
    corrected = F.col(PRES) - F.col("pressure_offset")
    in_water = (F.col(COND) > threshold(limit=limit)) & (corrected > 0)
    return rows.withColumns({
        "_keep": F.when(has_air, F.coalesce(in_water, F.lit(False))).otherwise(True),
        "_pressure_raw": F.col(PRES),
        "_oxygen_raw": F.col(OXY),
    }).withColumns({
        PRES: F.when(has_air, corrected).otherwise(F.col(PRES)),
        OXY: F.when(has_air, F.col(OXY) - F.col("oxygen_offset")).otherwise(F.col(OXY)),
    })


def _with_offsets_in_place(scans, cast, limit):
    """The offsets as window values: one shuffle by cast, for casts measured to fit a task (``chunk_size`` None)."""
    schema.require(scans, [cast, "ctd_type", COND, PRES, OXY])
    whole = Window.partitionBy(cast)
    air = F.col(COND) < threshold(limit=limit)
    par = F.avg(F.when(air, F.col(PAR))).over(whole) if PAR in scans.columns else F.lit(None).cast("double")
    rows = scans.withColumns({
        "n_air": F.count_if(air).over(whole),
        "pressure_offset": F.median(F.when(air, F.col(PRES))).over(whole),
        "_oxygen": F.median(F.when(air, F.col(OXY))).over(whole) - 100.0,
        "PAR_avg_air": par,
    })
    return rows.withColumns({
        "n_air": F.when(F.col("n_air") > 0, F.col("n_air")),
        "oxygen_offset": F.when(F.abs("_oxygen") > MAX_OXYGEN_OFFSET, 0.0).otherwise(F.col("_oxygen")),
    }).drop("_oxygen")


def apply_keep(rows):
    """Only the surviving rows, helper columns gone."""
    return rows.where("_keep").drop("_keep", "_pressure_raw", "_oxygen_raw", "n_air", "pressure_offset",
                                    "oxygen_offset")


def with_empty_cast_rows(rows, cast="cast_id", size=CHUNK):
    """Surviving rows plus, for casts with none left, the raw rows again (``processed`` is false there)."""
    if size is None:
        rows = rows.withColumn("_n_keep", F.count_if("_keep").over(Window.partitionBy(cast)))
    else:
        rows = rows.join(rows.groupBy(cast).agg(F.count_if("_keep").alias("_n_keep")), cast)
    rows = rows.where(F.col("_keep") | (F.col("_n_keep") == 0))
    alive = F.col("_n_keep") > 0
    return rows.withColumns({
        "processed": alive,
        PRES: F.when(alive, F.col(PRES)).otherwise(F.col("_pressure_raw")),
        OXY: F.when(alive, F.col(OXY)).otherwise(F.col("_oxygen_raw")),
        "PAR_avg_air": F.when(alive, F.col("PAR_avg_air")),
    }).drop("_keep", "_pressure_raw", "_oxygen_raw", "n_air", "pressure_offset", "oxygen_offset", "_n_keep")


def ph_qc(column="ph"):
    """pH outside the plausible range becomes missing."""
    return F.when(F.col(column).between(*PH_RANGE), F.col(column))


def qc_report(scans, cast="cast_id", limit=None, size=CHUNK):
    """One row per cast: what the cleaning found worth a warning."""
    offsets = air_offsets(scans, cast, limit, size)
    rows = air_correct(scans, cast, limit, offsets)
    water = F.col(COND) > threshold(limit=limit)
    has_air = F.col("n_air").isNotNull()
    stats = rows.groupBy(cast).agg(
        F.count("*").alias("n_scans"),
        F.count_if("_keep").alias("n_kept"),
        F.avg(F.when(has_air & water, F.col(OXY))).alias("_water_mean"),
        F.avg(F.when(F.col("_keep"), F.col(OXY))).alias("_kept_mean"))
    return stats.join(offsets.select(cast, "n_air", "bad_air_oxygen"), cast, "left").select(
        cast, "n_scans", "n_kept", F.coalesce("n_air", F.lit(0)).alias("n_air"),
        F.col("n_air").isNull().alias("no_air_data"),
        F.coalesce("bad_air_oxygen", F.lit(False)).alias("bad_air_oxygen"),
        F.coalesce(F.col("_water_mean") < 0, F.lit(False)).alias("negative_corrected_oxygen"),
        (F.col("n_kept") == 0).alias("no_water_data"),
        F.coalesce(F.col("_kept_mean") < 0, F.lit(False)).alias("negative_profile_oxygen"),
        (F.col("n_scans") < 21).alias("too_short_to_segment"))
