"""Derived columns of a cast: seawater properties, mixed layer, downcast flag, buoyancy frequency."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathomline import schema
from fathomline.functions import seawater
from fathomline.operators import sequence
from fathomline.storage import save_stage

# Rows deeper than this count for the mixed layer; differences that end it.
MLD_MIN_PRESSURE = 1.0
MLD_TEMPERATURE = 0.2
MLD_DENSITY = 0.03
# Fixed value: the conductivity the vendor's salinity is recomputed against.
VENDOR_CONDUCTIVITY = 42.914
# Width of a pressure band: nearest-pressure search never looks at more than one band plus its borders.
BAND = 2.0

PRES, TEMP, SAL, OXY = "pressure_dbar", "temperature_C", "salinity_psu", "oxygen_saturation_percent"


def with_depth(rows, cast="cast_id", latitude=schema.SITE_LATITUDE):
    """``depth_m`` from pressure for casts that measured none; measured depths stay."""
    depth = F.expr(seawater.depth_from_pressure(PRES, latitude))
    if "depth_m" not in rows.columns:
        return rows.withColumn("depth_m", depth)
    measured = rows.groupBy(cast).agg(F.bool_or(F.col("depth_m").isNotNull()).alias("_measured"))
    return rows.join(measured, cast).withColumn(
        "depth_m", F.when(F.col("_measured"), F.col("depth_m")).otherwise(depth)).drop("_measured")


def with_oxygen(rows):
    """Solubility (from potential temperature) and the two concentrations (from in-situ temperature)."""
    solid = seawater.solid
    rows = seawater.with_columns(rows, _y=solid(seawater.oxygen_log("pot_temp_C")), _t=solid(TEMP), _s=solid(SAL),
                                 _o=solid(OXY))
    rows = seawater.with_columns(
        rows, _mll=f"{seawater.oxygen_solubility('_s', '_y')} * {seawater.ML_PER_UMOL}D",
        _mgkg=seawater.oxygen_mgkg("_t", "_s", "_o"), _mgl=seawater.oxygen_mgl("_t", "_s", "_o"))
    return seawater.with_columns(rows, **{name: seawater.hollow(value) for name, value in {
        "o2_solubility_mll": "_mll", "o2_solubility_mgl": f"_mll * {seawater.MG_PER_ML}D", "o2_mgkg": "_mgkg",
        "o2_mgl": "_mgl"}.items()}).drop("_y", "_t", "_s", "_o", "_mll", "_mgkg", "_mgl")


def with_vendor_salinity(rows, divisor=VENDOR_CONDUCTIVITY, active=None):
    """Seabird rows: measured salinity moves to ``salinity_psu_seabird``, the new one comes from conductivity.

    ``active`` (a condition) limits it to rows that are processed at all.
    """
    vendor = F.lower("ctd_type") == "seabird"
    vendor = vendor if active is None else vendor & active
    ratio = f"(conductivity_mS_per_m / {seawater.number(float(divisor))})"
    rows = seawater.with_columns(rows, _root=seawater.ratio_root(ratio, TEMP, PRES))
    rows = seawater.with_columns(rows, _fresh=seawater.practical_salinity("_root", TEMP))
    return rows.withColumns({
        "salinity_psu_seabird": F.when(vendor, F.col(SAL)),
        SAL: F.when(vendor, F.when(~F.isnan("_fresh"), F.col("_fresh"))).otherwise(F.col(SAL)),
    }).drop("_root", "_fresh")


def _layer_ends(order):
    """Aggregates over rows that carry the surface values ``_t0`` and ``_d0``."""
    counts = F.col(PRES) > MLD_MIN_PRESSURE
    warm = F.abs(F.col(TEMP) - F.col("_t0")) > MLD_TEMPERATURE
    dense = F.abs(F.col("density_kg_m3") - F.col("_d0")) > MLD_DENSITY
    return [F.min_by(PRES, F.when(counts & warm, F.col(order))).alias("mld_temp"),
            F.min_by(PRES, F.when(counts & dense, F.col(order))).alias("mld_dens")]


def mixed_layer(rows, cast="cast_id", order="scan"):
    """One row per cast: ``mld_temp`` and ``mld_dens``, missing where the cast never leaves the layer."""
    deep = rows.where(F.col(PRES) > MLD_MIN_PRESSURE).select(cast, order, PRES, TEMP, "density_kg_m3")
    surface = deep.groupBy(cast).agg(F.min_by(TEMP, order).alias("_t0"), F.min_by("density_kg_m3", order).alias("_d0"))
    return deep.join(surface, cast).groupBy(cast).agg(*_layer_ends(order))


def first_deepest(depth, order):
    """Aggregate: the first scan at the greatest depth; missing depths do not count. One pass: of equal depths the greatest
    negative scan wins."""
    return -F.max(F.when(F.col(depth).isNotNull(), F.struct(F.col(depth), (-F.col(order)).alias("back"))))["back"]


def downcast_end(rows, cast="cast_id", order="scan", depth="depth_m"):
    """One row per cast: the first scan at the greatest depth."""
    return rows.groupBy(cast).agg(first_deepest(depth, order).alias("downcast_end"))


def with_downcast(rows, cast="cast_id", order="scan"):
    """``is_downcast``: up to and including the first greatest depth (pressure where there is no depth)."""
    depth = "depth_m" if "depth_m" in rows.columns else PRES
    return rows.join(downcast_end(rows, cast, order, depth), cast, "left").withColumn(
        "is_downcast", F.coalesce(F.col(order) <= F.col("downcast_end"), F.lit(False))).drop("downcast_end")


def cast_marks(rows, cast="cast_id", order="scan"):
    """Mixed layer and downcast end together: two passes of one aggregate each."""
    counts = F.col(PRES) > MLD_MIN_PRESSURE
    first = F.when(counts, F.col(order))
    head = rows.groupBy(cast).agg(
        F.min_by(TEMP, first).alias("_t0"), F.min_by("density_kg_m3", first).alias("_d0"),
        first_deepest("depth_m", order).alias("downcast_end"))
    return rows.join(head, cast).groupBy(cast).agg(*_layer_ends(order), F.max("downcast_end").alias("downcast_end"))


def n2_pairs(rows, cast="cast_id", order="scan", size=sequence.CHUNK):
    """Buoyancy frequency between consecutive rows with a pressure change after them.

    Input rows carry ``_SA`` and ``_CT``. Output: ``mid_no`` (the upper row's order), ``p_mid``, ``N2``. The pressure is
    absolute; a row stays when the next row's pressure differs, so the last row never stays.
    """
    points = rows.select(cast, order, F.abs(PRES).alias("_p"), "_SA", "_CT")
    points = sequence.next_row(points, [cast], order, ["_p"], size)
    kept = points.where(F.col("next__p").isNotNull() & (F.col("next__p") != F.col("_p"))).select(
        cast, order, "_p", "_SA", "_CT")
    pairs = sequence.next_row(kept, [cast], order, ["_p", "_SA", "_CT"], size).where(F.col(f"next_{order}").isNotNull())
    pairs = seawater.with_buoyancy(pairs)
    return pairs.select(cast, F.col(order).alias("mid_no"), ((F.col("_p") + F.col("next__p")) * 0.5).alias("p_mid"), "N2")


def n2_nearest(rows, pairs, cast="cast_id", order="scan", size=sequence.CHUNK, dealt=False):
    """Each mid-point's N2 on the scan nearest in pressure; ``(cast, scan, N2)``.

    Ties go to the smaller scan, and of several mid-points on one scan the last stays. Points and mid-points are first
    reduced to distinct pressures (the sensor's resolution bounds them), then each mid-point takes the nearest point
    above and below inside its pressure band or, across bands, from the band summary. ``dealt``: both tables lie in the same
    buckets by cast already.
    """
    points = rows.select(cast, F.abs(PRES).alias("_at"), F.col(order).alias("_scan"))
    mids = pairs.select(cast, F.col("p_mid").alias("_at"), F.col("mid_no").alias("_mid_no"), F.col("N2").alias("_n2"))
    # Points and mid-points at the same pressure share a row, so the order within a cast is strict.
    axis = points.unionByName(mids, allowMissingColumns=True).where("_at IS NOT NULL")
    if size is None and not dealt:
        # Casts fit a task, so all that follows happens where this one shuffle puts them.
        axis = axis.repartition(cast)
    axis = axis.groupBy(cast, "_at").agg(
        F.min("_scan").alias("_scan"), F.max("_mid_no").alias("_mid_no"), F.max_by("_n2", "_mid_no").alias("_n2"))
    axis = axis.withColumn("_point", F.when(F.col("_scan").isNotNull(), F.struct(
        F.col("_at").alias("p"), F.col("_scan").alias("s"))))
    if size is not None:
        axis = save_stage(axis, "axis")
    band = None if size is None else BAND
    axis = sequence.last_known(axis, [cast], "_at", "_point", "_below", band)
    axis = sequence.last_known(axis, [cast], "_at", "_point", "_above", band, later=True)
    down, up = F.col("_at") - F.col("_below.p"), F.col("_above.p") - F.col("_at")
    target = (F.when(F.col("_above").isNull() | (down < up), F.col("_below.s"))
              .when(F.col("_below").isNull() | (up < down), F.col("_above.s"))
              .otherwise(F.least("_below.s", "_above.s")))
    return axis.where(F.col("_mid_no").isNotNull()).select(cast, target.alias(order), "_mid_no", "_n2").groupBy(
        cast, order).agg(F.max_by("_n2", "_mid_no").alias("N2"))


def with_n2(rows, n2, cast="cast_id", order="scan", size=sequence.CHUNK, dealt=False):
    """``N2`` of ``n2_nearest`` on its scans; NULL elsewhere.

    While casts fit a task the values come in as rows of their own, so rows and values meet in one shuffle by cast that
    the later joins on the cast reuse; a join on cast and scan would move the whole rows again. Where both are ``dealt`` by
    cast nothing moves.
    """
    if size is not None:
        return rows.join(n2, [cast, order], "left")
    n2 = n2.where(F.col(cast).isNotNull() & F.col(order).isNotNull()).select(cast, order, "N2", F.lit(False).alias("_row"))
    both = rows.withColumn("_row", F.lit(True)).unionByName(n2, allowMissingColumns=True)
    both = both if dealt else both.repartition(cast)
    here = Window.partitionBy(cast, order)
    return both.withColumn("N2", F.max("N2").over(here)).where("_row").drop("_row")
