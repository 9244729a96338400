"""Session builder with the settings the jobs rely on."""

from pyspark.sql import SparkSession

SETTINGS = {
    # Instrument clocks carry no zone, so results must not depend on the session zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Stage and level tables are most of what a job writes; this is smaller than the default.
    "spark.sql.parquet.compression.codec": "zstd",
    # Shuffles are dealt finely and joined to parts of this size, so a task's memory does not grow with the input, whatever
    # number of shuffle partitions the session was built with.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    # What one task reads, so that the rows it deals into a shuffle fit its memory; the second keeps 32 small files to a task.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.files.openCostInBytes": "512k",
    # A folder per profile: listed by few tasks with many folders each instead of a task for each folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "200",
    # Rows of one huge cast are joined to their one-row statistics; the skew rule splits that partition.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The seawater polynomials make one generated method longer than the JVM's compiler accepts (8000 bytes of bytecode),
    # and it would then be interpreted. Past this limit Spark evaluates the projection through small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark):
    """Apply the settings to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(master=None, **extra):
    """Build or reuse a session. Cluster settings (executors, shuffle partitions) stay with the caller."""
    builder = SparkSession.builder.appName("fathomline")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
