"""Standard tables derived from the driver's tables (FIXTURES.md section 3), one stage table per session and input.

``level1`` plays the part of the ingested Level1 table: it is written once, sorted by cast and scan, and every query
reads it with column pruning.
"""

from pyspark.sql import functions as F

from fathomline.operators.sequence import WHOLE_LIMIT, number_rows
from fathomline.storage import save_stage

_TABLES = {}


def once(spark, sf_dir, label, build):
    """Build a table the first time it is asked for in this session, then read the written one."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _TABLES:
        _TABLES[key] = save_stage(build(), label)
    return _TABLES[key]


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def level1(spark, sf_dir):
    """Scans keyed by ``(cast_id, scan)``; see FIXTURES.md 3.1. RBR casts carry ``timestamp``, the others ``datetime``."""
    return once(spark, sf_dir, "level1", lambda: _level1(spark, sf_dir))


def _level1(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("cast_no"), "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate",
        F.col("l_quantity").alias("q"), (F.col("l_discount") + 0.0).alias("d"), (F.col("l_tax") + 0.0).alias("x"),
        F.col("l_extendedprice").alias("e"))
    r = number_rows(lines, ["cast_no"], ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"], "scan", "level0", WHOLE_LIMIT)
    no, scan, d, x = F.col("cast_no"), F.col("scan"), F.col("d"), F.col("x")
    air = ((scan < 24) & (no % 7 != 3)) | (no % 31 == 30)
    base = F.when(scan < 24, 0.0).otherwise(60.0 - F.abs(((scan - 24) % 240) - 120) * 0.5)
    r = r.withColumns({"in_air": air, "base": base})
    air, base = F.col("in_air"), F.col("base")
    kind = F.element_at(F.array(*map(F.lit, ["idronaut", "seabird", "rbr", "exo", "gf23"])),
                        (no % 5 + 1).cast("int"))
    clock = F.expr("timestampadd(SECOND, scan + (cast_no % 10) * 60, timestampadd(DAY, (cast_no div 10) % 3650, "
                   "TIMESTAMP_NTZ'2024-07-03 08:00:00'))")
    return r.select(
        "cast_no", F.concat(F.lit("cast_"), no.cast("string")).alias("cast_id"), "scan", kind.alias("ctd_type"),
        F.concat(F.lit("cast_"), no.cast("string"), F.lit(".txt")).alias("source_file"),
        F.when(kind == "rbr", clock).alias("timestamp"), F.when(kind != "rbr", clock).alias("datetime"),
        F.round(F.when(air, x + 0.25).otherwise(base + 0.5 + d), 4).alias("pressure_dbar"),
        F.round(18.0 - base * 0.2 + d, 4).alias("temperature_C"),
        F.when(air, F.round(d * 0.5 + 0.01, 4)).when(scan == 24, 0.15)
        .otherwise(F.round(base * 10.0 + 2500.0 + x * 100.0, 4)).alias("conductivity_mS_per_m"),
        F.round(base * 0.2 + 20.0 + x, 4).alias("salinity_psu"),
        F.round(F.when(air & (no % 11 == 5), 180.0).when(air, x * 10.0 + 101.5)
                .otherwise(96.0 - base * 0.5 + d), 4).alias("oxygen_saturation_percent"),
        F.when(F.col("q") != 50, F.round(F.col("q") * 0.08 + 5.5, 4)).alias("ph"),
        F.round(F.col("e") / 100.0, 4).alias("PAR_umol_m2_s"))


def logbook(spark, sf_dir):
    """Station entries; see FIXTURES.md 3.2."""
    k = F.col("s_suppkey")
    text = k.cast("string")
    return table(spark, sf_dir, "supplier").select(
        k.alias("entry_no"), F.concat(F.lit("ST"), (k % 26).cast("string")).alias("Station"),
        (k % 40 + 1).cast("double").alias("station_ODV"),
        F.when(k % 3 != 0, F.concat(F.lit("campaign_"), F.col("s_nationkey").cast("string"))).alias("campaign"),
        F.when(k % 4 == 1, F.concat(F.lit("cast_"), text, F.lit("_1.csv")))
        .when(k % 4 == 2, F.concat(F.lit("cast_"), text, F.lit("_9.csv")))
        .when(k % 4 == 3, F.concat(F.lit("missing_"), text, F.lit(".csv"))).alias("ctd_file"),
        F.when(k % 5 == 0, F.concat(F.lit("suboceanexperiment_"), text, F.lit(".txt"))).alias("subocean_file"),
        F.when(k % 7 == 1, F.concat(F.lit("KOR_"), text, F.lit(".CSV"))).alias("exo_file"),
        F.when(k % 7 == 2, F.concat(F.lit("_"), text, F.lit("_b"))).alias("exo_file_2"),
        (60.0 + (k % 50) * 0.01).alias("Latitude"), (-45.0 - (k % 50) * 0.02).alias("Longitude"))


def profiles(spark, sf_dir):
    """Paths of processed profile files: two per cast."""
    return table(spark, sf_dir, "supplier").select(
        F.explode(F.array(F.lit(1), F.lit(2))).alias("part"), F.col("s_suppkey").alias("k")).select(
        F.format_string("level2/cast_%d_%d.csv", "k", "part").alias("path"))


def raw_files(spark, sf_dir):
    """Paths of a raw data tree: several instruments, upper and lower case, files in more than one folder."""
    names = F.array(
        F.format_string("raw/a/suboceanexperiment_%d.txt", "k"),
        F.format_string("raw/b/suboceanexperiment_%d.txt", "k"),
        F.format_string("raw/exo/kor_%d.csv", "k"),
        F.format_string("raw/exo/day_%d_b_kor.csv", "k"),
        F.format_string("raw/a-x/day_%d_b_kor.csv", "k"),
        F.format_string("raw/sb/cast_%d.CNV", "k"),
        F.format_string("raw/idro/20240703_%d_Idronaut.txt", "k"),
        F.format_string("raw/RBR/cast_%d_data.txt", "k"),
        F.format_string("raw/gf/ST%d.TXT", "k"),
        F.format_string("raw/doc/note_%d.pdf", "k"))
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k")).select("k", F.explode(names).alias("path"))
