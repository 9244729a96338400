"""Side tables, level tables and their sinks."""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathomline.functions.text import base_name, directory, stem, unit_map
from fathomline.sources.files import csv_cells, csv_records, file_lines, file_manifest
from fathomline.storage import save_sorted_files

# Tasks move their own files when they are done; with Hadoop's first way the driver moves each folder of a table, one by one.
BY_TASKS = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
# Bytes that a file of a level table should hold, and what a value of a row takes about.
FILE_BYTES = 128 << 20
VALUE_BYTES = 8
# Layout files are as many as profiles, however small: a task writes this part of what a file may hold.
LAYOUT_SHARE = 8

ACTIVITY_LOG = "activity_log_odv.csv"
LOGBOOK_NAMES = {"CTD file": "ctd_file", "Subocean File": "subocean_file", "Exo file": "exo_file",
                 "Exo file 2": "exo_file_2"}


def read_logbook(spark, path):
    """``;``-separated logbook; optional columns that are absent come as NULL, rows are numbered in file order."""
    raw = spark.read.option("sep", ";").option("header", True).option("encoding", "UTF-8").csv(path)
    return standard_logbook(raw)


def standard_logbook(raw):
    rows = raw.withColumnsRenamed(LOGBOOK_NAMES)
    for name in ("campaign", *LOGBOOK_NAMES.values()):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("string"))
    if "entry_no" not in rows.columns:
        rows = rows.withColumn("entry_no", F.monotonically_increasing_id())
    return rows


def unit_table(data_files, sidecars):
    """``(path, units)``: the unit list belonging to each RBR data file.

    ``sidecars`` is ``(path, text)``. Choice: the three names built from the data file's, else the first JSON of its
    folder. Both are equi-joins, the second on one row per folder, however many files the folder holds.
    """
    path = F.col("path")
    base = F.concat(directory(path), F.lit("/"), F.regexp_replace(base_name(path), r"^(.*)_data.*$", "$1"))
    near = data_files.select("path", directory(path).alias("_dir"), F.posexplode(F.array(*[
        F.concat(base, F.lit(end)) for end in ("_metadata.txt", "_metadata.json", ".json")])).alias("rank", "sidecar"))
    named = near.join(sidecars.select(path.alias("sidecar")), "sidecar").groupBy("path").agg(
        F.min_by("sidecar", "rank").alias("_named"))
    first = sidecars.where(path.endswith(".json")).groupBy(directory(path).alias("_dir")).agg(
        F.min("path").alias("_first"))
    chosen = data_files.select("path", directory(path).alias("_dir")).join(named, "path", "left").join(
        first, "_dir", "left").select("path", F.coalesce("_named", "_first").alias("sidecar"))
    units = sidecars.select(path.alias("sidecar"), unit_map(F.col("text")).alias("units"))
    return chosen.join(units, "sidecar").select("path", "units").where("units IS NOT NULL")


def is_sidecar():
    """Whether a path is that of a unit list."""
    return F.col("path").endswith(".json") | F.col("path").endswith("_metadata.txt")


def sidecar_texts(lines):
    """``(path, text)`` of unit lists: files named ``*.json`` or ``*_metadata.txt``, a few lines each."""
    named = lines.where(is_sidecar())
    return named.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("line_no", "line"))), lambda e: e["line"]), "\n").alias("text"))


def activity_rows(lines, name=ACTIVITY_LOG):
    """Rows of every activity log among the lines (``csv_records``), as text by column, with the ``folder`` the log lies in.

    Columns are found by each log's own header. Of several spellings in one folder the first path counts.
    """
    mine = lines.where((F.lower(base_name(F.col("path"))) == name) & (F.trim("line") != ""))
    mine = mine.withColumn("folder", directory(F.col("path")))
    heads = mine.where("row_no = 0").groupBy("folder").agg(F.min(F.struct("path", csv_cells(F.col("line")).alias("names"))).alias("_h"))
    heads = heads.select(F.col("_h.path").alias("path"), F.transform("_h.names", lambda n: F.trim(n)).alias("names"))
    rows = mine.where("row_no > 0").join(heads, "path").withColumn("cells", csv_cells(F.col("line")))
    wanted = ("Activity", "station_ID", "station_ODV", "date", "lat IN", "lat OUT", "long IN", "time In")
    return rows.select("folder", *[F.nullif(F.get("cells", (F.array_position("names", F.lit(c)) - 1).cast("int")), F.lit("")).alias(c)
                                   for c in wanted])


def nearest_folder(files, folders):
    """``(path, folder)``: the closest of the ``folders`` that a file lies in, its own or one further up.

    A file lists its own path upwards and meets the folders on equal text.
    """
    parts = F.split(directory(F.col("path")), "/")
    upwards = F.transform(F.sequence(F.size(parts), F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    steps = files.select("path", F.posexplode(upwards).alias("_far", "folder"))
    return steps.join(folders.select("folder").distinct(), "folder").groupBy("path").agg(F.min_by("folder", "_far").alias("folder"))


def written_whole(spark, path, write):
    """``write(place)`` beside ``path``, then moved there in one step: readers see the old table or the new one, and a job
    that fails or a task that is run twice leaves ``path`` as it was."""
    place = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    write(place)
    files = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (place, path))
    files.delete(old, True)
    files.mkdirs(old.getParent())
    if not files.rename(new, old):
        raise OSError(f"{place} is complete but could not be moved to {path}")
    return path


def file_rows(rows, file_bytes=FILE_BYTES):
    """Rows that a file of about that size holds."""
    return max(1, file_bytes // (VALUE_BYTES * len(rows.columns)))


def clustered(rows, order, file_bytes=FILE_BYTES):
    """Rows in as many sorted ranges of ``order`` as files are needed for them all; runs one count."""
    n = -(-rows.count() // file_rows(rows, file_bytes)) or 1
    return rows.repartitionByRange(n, *order).sortWithinPartitions(*order)


def as_text(rows):
    """Maps, arrays and structs as JSON, for forms that only know plain values."""
    nested = {c: F.to_json(c) for c, t in rows.dtypes if t.startswith(("map", "array", "struct"))}
    return rows.withColumns(nested) if nested else rows


def write_profiles(rows, path, by=("campaign",), order=("cast_id", "scan"), form="parquet", file_bytes=FILE_BYTES, placed=False):
    """Level1/Level2 sink: a folder per campaign (or per ``by``), inside it files of about ``file_bytes`` sorted by cast and scan.

    A file holds many small casts, a huge cast is several files; the order lets a reader skip the files of other casts. The
    number of files is that of the bytes plus one per folder at most. Maps become JSON in the CSV form. ``placed``: the
    partitions are what the files should hold already (``jobs.process_for_sink``), so rows are only sorted inside them.
    """
    rows = rows if form == "parquet" else as_text(rows)

    def write(place):
        ranges = rows.sortWithinPartitions(*by, *order) if placed else clustered(rows, [*by, *order], file_bytes)
        writer = ranges.write.options(**BY_TASKS).partitionBy(*by).option("header", form == "csv")
        writer.format(form).save(place)

    return written_whole(rows.sparkSession, path, write)


def write_stations(rows, path, by=("campaign", "Station"), order=("cast_id", "scan"), file_bytes=FILE_BYTES):
    """Level2B sink: the matched rows of each station; only the stations at hand are overwritten."""
    clustered(rows, [*by, *order], file_bytes).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    return path


def write_layout(layout, path, profile="cast_id", direction=None, sort="PrdE", keep_sort=True, file_bytes=FILE_BYTES):
    """Tab-separated ``.asc`` text: a folder ``file=<profile><direction>_formatted`` each, sorted by ``sort`` throughout.

    A profile is range-partitioned by ``sort``, so a huge one is written by several tasks as parts whose names follow the
    order; ``read_layout`` counts on through them. Each part has the header. ``keep_sort`` leaves the sort column in. A task
    writes an eighth of ``file_bytes``: there are as many files as profiles, and it is the files that take the time.
    """
    tag = F.lit("_formatted") if direction is None else F.concat(F.lit("_"), F.col(direction), F.lit("_formatted"))
    named = layout.withColumn("file", F.concat(F.col(profile), tag)).drop(profile, *([direction] if direction else []))
    named = clustered(named, ["file", sort], max(1, file_bytes // LAYOUT_SHARE))
    shown = [c for c in named.columns if c != "file" and (keep_sort or c != sort)]
    lines = named.select("file", F.to_csv(F.struct(*shown), {"sep": "\t"}).alias("value"))
    return written_whole(layout.sparkSession, path, lambda place: save_sorted_files(lines, place, "\t".join(shown), "asc"))


def write_csv_profiles(rows, path, by="profile_name"):
    """Profiles as CSV text: a folder ``<by>=<value>`` each, of one file with a header. The tasks write them, one after the other."""
    shown = [c for c in rows.columns if c != by]
    named = rows.repartition(by).sortWithinPartitions(by).select(F.col(by).cast("string").alias("file"), F.to_csv(F.struct(*shown)).alias("value"))
    return written_whole(rows.sparkSession, path, lambda place: save_sorted_files(named, place, ",".join(shown), "csv", by))


def read_layout(spark, path):
    """The rows of ``write_layout``: ``(file, row_no, cells)``, ``row_no`` counting through the parts of a file, ``cells`` a MAP."""
    listing = file_manifest(spark, path, (".asc",)).withColumn("file", F.regexp_extract("path", r"/file=([^/]+)/", 1))
    lines = file_lines(listing, ("file",)).where(F.trim("line") != "")
    earlier = Window.partitionBy("file").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part: its header and how many rows the parts before it hold.
    parts = lines.groupBy("file", "path").agg(
        (F.count("*") - 1).alias("_held"), F.max(F.when(F.col("row_no") == 0, F.col("line"))).alias("_head"))
    parts = parts.select("path", F.split("_head", "\t").alias("names"), F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"))
    rows = lines.where("row_no > 0").join(parts, "path")
    return rows.select("file", (F.col("row_no") - 1 + F.col("_before")).alias("row_no"),
                       F.map_from_arrays("names", F.split("line", "\t")).alias("cells"))


def read_profiles(spark, path, columns):
    """All CSV profiles under a tree as one table: names with "metadata" left out, each row tagged ``profile_name``.

    ``columns`` maps the wanted names to types; they are found by each file's own header, so files with different
    columns line up and a column a file lacks is NULL. The tag is the file's stem, or its ``profile_name=`` folder.
    """
    listing = file_manifest(spark, path, (".csv",))
    folder = F.regexp_extract("path", r"/profile_name=([^/]+)/", 1)
    listing = listing.where(~F.lower(base_name(F.col("path"))).contains("metadata") & ~F.lower(folder).contains("metadata")).withColumn(
        "profile_name", F.when(folder != "", folder).otherwise(stem(F.col("path"))))
    lines = csv_records(file_lines(listing, ("profile_name",)))
    heads = lines.where((F.col("row_no") == 0) & (F.trim("line") != "")).select("path", csv_cells(F.col("line")).alias("names"))
    heads = heads.select("path", F.struct(*[
        F.array_position("names", F.lit(c)).cast("int").alias(c) for c in columns]).alias("at"))
    rows = lines.where((F.col("row_no") > 0) & (F.trim("line") != "")).join(heads, "path").withColumn(
        "cells", F.when(F.contains("line", F.lit('"')), csv_cells(F.col("line"))).otherwise(F.split("line", ",")))
    return rows.select(*[
        F.nullif(F.get("cells", F.col("at")[c] - 1), F.lit("")).try_cast(kind).alias(c) for c, kind in columns.items()
    ], "profile_name")


def combine(tables):
    """Union by name; columns a table lacks are NULL."""
    whole = tables[0]
    for more in tables[1:]:
        whole = whole.unionByName(more, allowMissingColumns=True)
    return whole


def write_combined(rows, path, by="campaign", order=("profile_name", "scan"), file_bytes=FILE_BYTES, placed=False):
    """The campaign table the summaries read: columnar, a folder per campaign, files sorted by profile."""
    return write_profiles(rows, path, (by,), order, file_bytes=file_bytes, placed=placed)
