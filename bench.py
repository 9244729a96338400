"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line.

Every query runs to the end into a sink that discards rows: once to warm up, then the median of the timed runs. Stage
tables a query shares with others (Level1, Level2) are timed on their own as ``build_*``.
"""

import json
import os
import statistics
import sys
import time

from fathomline import get_session
from fathomline.plans import catalogue

RUNS = int(os.environ.get("BENCH_RUNS", "2"))
HEADLINE = ["process_casts", "segment_profiles", "n2_nearest", "sheet_station", "cast_summary", "air_offsets",
            "concat_daily", "ingest_rbr", "ingest_seabird", "logbook_prefix", "related_files", "a2ps_split",
            "measure_totals", "sheet_measurement", "profile_long"]


def run(df):
    df.write.format("noop").mode("overwrite").save()


def timed(action):
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = get_session(f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "20g"),
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {
        "build_level1": timed(lambda: catalogue.level1(spark, sf_dir)),
        "build_level2": timed(lambda: catalogue.processed(spark, sf_dir)),
    }
    for name in HEADLINE:
        build = catalogue.QUERIES[name]
        print(f"{name}: warm-up {timed(lambda: run(build(spark, sf_dir))):.2f}", file=sys.stderr)
        times[name] = statistics.median(timed(lambda: run(build(spark, sf_dir))) for _ in range(RUNS))
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()}, "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
