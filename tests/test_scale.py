"""What keeps memory, shuffles and the driver's work from growing faster than the input."""

import os

from pyspark.sql import functions as F

from fathomline.operators import export, layers, sequence, stations
from fathomline.plans import jobs
from fathomline.session import tune
from fathomline.sources import tables
from fathomline.storage import recorded, save_named_files, stage_path


def broadcast_parts(plan):
    """The subtrees under each broadcast of a plan, as lists of lines."""
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            yield lines[i + 1:end]


def test_related_files_broadcast_no_unfolded_list(spark):
    ids = spark.range(500).withColumn("k", F.lpad(F.col("id").cast("string"), 6, "0"))
    entries = ids.select(F.col("id").alias("entry_no"), F.concat(F.lit("sub_"), "k", F.lit(".txt")).alias("subocean_file"),
                         F.concat(F.lit("_"), "k").alias("exo_file"), F.lit(None).cast("string").alias("exo_file_2"))
    files = ids.select(F.explode(F.array(F.concat(F.lit("raw/a/sub_"), "k", F.lit(".txt")),
                                         F.concat(F.lit("raw/b/x_"), "k", F.lit("_y.csv")))).alias("path"))
    found = stations.related_files(entries, files)
    plan = found._jdf.queryExecution().executedPlan().toString()
    for part in broadcast_parts(plan):
        assert not any("Generate" in line for line in part)
    rows = {(r.entry_no, r.kind): r.path for r in found.collect()}
    assert len(rows) == 1500
    assert rows[7, "subocean"] == "raw/a/sub_000007.txt" and rows[7, "subocean_log"] == "raw/a/sub_000007.log"
    assert rows[7, "exo_file"] == "raw/a/sub_000007.txt"


def test_related_files_short_texts_and_repeated_letters(spark):
    entries = spark.createDataFrame(
        [(1, "a", "aaaa", "ünï"), (2, "B", "longer than any name at all", "aaaaaaaaaa"), (3, None, "", "x_1.CSV")],
        "entry_no int, subocean_file string, exo_file string, exo_file_2 string")
    files = spark.createDataFrame([("q/aaaaaaaaaaaa.csv",), ("p/ünïcode.txt",), ("p/X_1.csv",), ("r/b",)], "path string")
    rows = {(r.entry_no, r.kind): r.path for r in stations.related_files(entries, files).collect()}
    assert rows == {(1, "subocean"): "q/aaaaaaaaaaaa.csv", (1, "subocean_log"): "q/aaaaaaaaaaaa.csv", (1, "exo_file"): "q/aaaaaaaaaaaa.csv",
                    (1, "exo_file_2"): "p/ünïcode.txt", (2, "subocean"): "r/b", (2, "subocean_log"): "r/b",
                    (2, "exo_file_2"): "q/aaaaaaaaaaaa.csv", (3, "exo_file_2"): "p/X_1.csv"}


def test_tasks_stay_small_with_few_shuffle_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        tune(spark).conf.set("spark.sql.shuffle.partitions", "2")
        rows = spark.range(8_000_000).repartition("id")
        assert rows.rdd.getNumPartitions() > 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_number_rows_of_small_keys_writes_no_stage(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), (F.col("id") * 37 % 2003).alias("v"))
    df = df.withColumn("k", F.when(F.col("k") != 3, F.col("k")))
    with recorded() as paths:
        small = sequence.number_rows(df, ["k"], ["v"], "n", whole_limit=1000)
        assert not paths
        large = sequence.number_rows(df, ["k"], ["v"], "n", whole_limit=10)
        assert paths
    assert small.schema["n"].dataType == large.schema["n"].dataType
    assert sorted(small.collect(), key=str) == sorted(large.collect(), key=str)


def test_named_files_are_written_by_tasks_whole_and_in_order(spark):
    root = stage_path(spark, "named")
    rows = spark.range(30_000).select(
        F.when(F.col("id") < 25_000, "süd 2/long.txt").when(F.col("id") < 29_999, F.concat(
            F.lit("north/a b/"), (F.col("id") % 3).cast("string"), F.lit(".CSV"))).alias("file"),
        (-F.col("id")).alias("line_no"), F.when(F.col("id") != 5, F.col("id").cast("string")).alias("value"))
    save_named_files(rows, root)
    place = root.removeprefix("file:")
    got = {os.path.relpath(os.path.join(d, n), place): open(os.path.join(d, n), encoding="utf-8").read()
           for d, _, names in os.walk(place) for n in names if not n.endswith(".crc")}
    assert set(got) == {"süd 2/long.txt", *(f"north/a b/{i}.CSV" for i in range(3))}
    assert got["süd 2/long.txt"] == "".join(f"{'' if i == 5 else i}\n" for i in range(24_999, -1, -1))
    assert got["north/a b/1.CSV"].startswith("29998\n") is (29_998 % 3 == 1)
    assert not os.path.exists(f"{place}-parts")


def test_n2_meets_its_scans_in_one_shuffle_by_cast(spark):
    rows = spark.createDataFrame([("a", 0, 1.0), ("a", 0, 2.0), ("a", 1, 3.0), ("b", 0, 4.0), (None, 0, 5.0)], "cast_id string, scan bigint, v double")
    n2 = spark.createDataFrame([("a", 0, 0.5), ("b", 1, 0.7), (None, 0, 0.9)], "cast_id string, scan bigint, N2 double")
    got = layers.with_n2(rows, n2, size=None)
    want = layers.with_n2(rows, n2)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(cast_id" in plan and not any("hashpartitioning" in line and "scan#" in line for line in plan.splitlines())


def test_layout_of_many_profiles_is_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(6000).selectExpr("concat('a:b ', id % 300) cast_id", "id scan", "id * 1D pressure_dbar", "nullif(id, 7) * 1D temperature_C",
                                        "30D salinity_psu", "90D oxygen_saturation_percent")
    rows = rows.selectExpr("if(scan = 11, null, cast_id) cast_id", "* except (cast_id)").withColumn("clock", F.expr("timestamp_ntz'2024-07-03 08:00:00'"))
    seen = []
    write = tables.save_sorted_files
    try:
        tables.save_sorted_files = lambda lines, *more: (seen.append(lines.rdd.getNumPartitions()), write(lines, *more))
        out = str(tmp_path / "clock")
        tables.write_layout(export.a2ps_clock(rows, clock="clock"), out, sort="scan", keep_sort=False, file_bytes=8 * 8 * 6000)
    finally:
        tables.save_sorted_files = write
    assert seen[0] > 4
    names = {p.name for p in (tmp_path / "clock").iterdir()}
    assert {"file=a%3Ab 0_formatted", "file=__HIVE_DEFAULT_PARTITION__"} <= names and len(names) == 301
    assert not [p for p in tmp_path.iterdir() if p.name != "clock"]
    text = next((tmp_path / "clock" / "file=a%3Ab 7_formatted").glob("part-*.asc")).read_text().splitlines()
    assert text[:2] == ["Tv2C\tSal2\tSbeox2PS\tPrdE\thh:mm:ss\tmm/dd/yyyy", f"\t30.0\t90.0\t{7 * 1.45038}\t08:00:00\t07/03/2024"]
    got = tables.read_layout(spark, out).groupBy("file").agg(F.count("*").alias("n"), F.max("row_no").alias("last")).collect()
    assert sum(r.n for r in got) == 6000 and all(r.last == r.n - 1 for r in got)
    tables.write_layout(export.a2ps_clock(rows.where("false"), clock="clock"), out, sort="scan", keep_sort=False)
    assert tables.read_layout(spark, out).count() == 0


def test_process_casts_shuffles_whole_rows_once(spark):
    rows = spark.range(4000).selectExpr(
        "if(id % 8 = 7, null, concat('c', id % 8)) cast_id", "id div 8 scan", "'exo' ctd_type", "(id div 8) * 0.5D pressure_dbar", "9D - (id div 8) * 0.01D temperature_C",
        "2600D conductivity_mS_per_m", "30D + (id div 8) * 0.01D salinity_psu", "90D oxygen_saturation_percent", "1D PAR_umol_m2_s", "8D ph",
        "timestamp_ntz'2024-07-03 08:00:00' datetime", "cast(null as timestamp_ntz) timestamp")
    done = jobs.process_casts(rows, size=None)
    assert "Exchange hash" not in done._jdf.queryExecution().executedPlan().toString()
    chunked = jobs.process_casts(rows, size=64)
    assert done.columns == chunked.columns

    def plain(df):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)

    # Beyond the size of a task casts are joined to their statistics, which drops rows without a cast.
    assert done.where("cast_id is null and N2 is null").count() == 500
    assert plain(done.where("cast_id is not null")) == plain(chunked)
    assert done.where("N2 is not null").select("cast_id").distinct().count() == 7


def test_a_task_reads_a_bounded_part_of_a_table(spark):
    path = stage_path(spark, "wide")
    tune(spark)
    spark.range(3_000_000).select(F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b")).coalesce(1).write.parquet(path)
    try:
        # As on a table so large that the cores alone do not divide it.
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        assert spark.read.parquet(path).rdd.getNumPartitions() > 2
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_casts_are_dealt_into_buckets_in_order(spark):
    casts = spark.range(500).selectExpr("if(id = 7, null, concat('c', id)) cast_id", "concat('f', id % 3) campaign", "id % 11 + 1 _held")
    keys, n = sequence.deal_keys(casts, ["campaign"], rows=100)
    rows = keys.join(casts, "cast_id").select("*", F.expr(f"pmod(hash(_deal), {n})").alias("bucket")).orderBy("campaign", "cast_id").collect()
    assert len(rows) == 499 == len({r._deal for r in rows})
    held = {}
    for r in rows:
        held.setdefault(r.bucket, []).append(r._held)
    # Casts of a bucket follow each other, buckets hold about as many rows, and none is empty.
    buckets = [r.bucket for r in rows]
    assert sum(a != b for a, b in zip(buckets, buckets[1:])) == n - 1 == len(held) - 1 and all(sum(h) <= 111 for h in held.values())
    assert sequence.deal_keys(casts.where("false"), ["campaign"])[1] == 1


def test_sink_moves_scans_once(spark, tmp_path):
    rows = spark.range(24_000).selectExpr(
        "if(id % 60 = 59, null, concat('c', id % 60)) cast_id", "id div 60 scan", "if(id % 60 < 9, 'seabird', 'exo') ctd_type", "if(id div 60 < 4, 0.4D, (id div 60) * 0.5D) pressure_dbar",
        "9D - (id div 60) * 0.01D temperature_C", "if(id div 60 < 4 or id % 60 = 5, 0.1D, 2600D) conductivity_mS_per_m", "30D + (id div 60) * 0.01D salinity_psu",
        "90D oxygen_saturation_percent", "1D PAR_umol_m2_s", "8D ph", "timestamp_ntz'2024-07-03 08:00:00' datetime", "cast(null as timestamp_ntz) timestamp")
    # One cast without an entry, one with two in two folders, and an entry without a cast.
    entries = spark.range(62).where("id <> 3").selectExpr("concat('c', id) cast_id", "concat('f', id % 4) campaign", "id Station").unionByName(
        spark.createDataFrame([("c8", "f3", 99)], "cast_id string, campaign string, Station bigint"))
    old = sequence.BUCKET_ROWS
    try:
        sequence.BUCKET_ROWS = 2000
        done = jobs.process_for_sink(rows, entries, ["campaign"])
    finally:
        sequence.BUCKET_ROWS = old
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "Exchange range" not in plan
    out = str(tmp_path / "level2")
    tables.write_profiles(done, out, placed=True)
    found = sorted((tmp_path / "level2").rglob("*.parquet"))
    n = done.rdd.getNumPartitions()
    # As many files as buckets and one more at most for each folder, and one for the cast that lies in two.
    assert n > 9 and n <= len(found) <= n + 5
    want = jobs.process_casts(rows, size=None).join(entries, "cast_id")

    def plain(df):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(want.columns).collect()), key=str)

    assert sorted(done.columns) == sorted(want.columns)
    assert plain(spark.read.parquet(out)) == plain(want) and spark.read.parquet(out).where("cast_id = 'c8'").select("campaign").distinct().count() == 2
    few = jobs.MOST_KEYS
    try:
        jobs.MOST_KEYS = 0
        assert plain(jobs.process_for_sink(rows, entries, ["campaign"])) == plain(want)
    finally:
        jobs.MOST_KEYS = few
