"""Composite jobs: from standard scans to processed casts, daily groups, station tables and the combined table."""

from pyspark.sql import functions as F

from fathomline import schema
from fathomline.functions import seawater
from fathomline.functions.text import base_name, directory
from fathomline.operators import clean, export, layers, reports, segment, sequence, stations
from fathomline.sources import files, instruments, tables
from fathomline.storage import save_buckets, save_stage

DERIVED = [
    "pot_temp_C", "density_kg_m3", "mld_temp", "mld_dens", "o2_solubility_mll", "o2_solubility_mgl", "o2_mgkg",
    "o2_mgl", "N2", "salinity_psu_seabird", "is_downcast",
]


# Keys of casts up to this number go to every task; beyond it the scans are shuffled to meet them.
MOST_KEYS = 500_000


def derived_rows(scans, cast="cast_id", latitude=schema.SITE_LATITUDE, saar=None, size=sequence.CHUNK):
    """Cleaned rows with depth, absolute salinity, temperatures, density: everything that needs no second look."""
    schema.require(scans, [cast, *schema.REQUIRED_COLUMNS])
    rows = clean.with_empty_cast_rows(clean.air_correct(scans, cast, size=size), cast, size)
    rows = layers.with_depth(rows, cast, latitude)
    return seawater.with_properties(rows, saar=saar)


def process_casts(scans, cast="cast_id", order="scan", latitude=schema.SITE_LATITUDE, saar=None, size=0, buckets=None):
    """Clean, derive, flag and quality-check whole casts.

    The cleaned rows are read three times (cast marks, N2, result), so they are one table in the shared folder and the
    cleaning and the seawater chain run once. While casts fit a task the table is dealt into buckets of whole casts, so that
    one shuffle serves all that follows. ``size`` is the chunk size, measured when it is 0; ``buckets`` the number of them that
    the casts' keys were made for (``deal_keys``).
    """
    size = sequence.chunk_size(scans, [cast]) if size == 0 else size
    n = (buckets or sequence.bucket_number(scans)) if size is None else None
    if n:
        rows = save_buckets(derived_rows(scans.repartition(n, cast), cast, latitude, saar, size), "derived", cast, n)
    else:
        rows = save_stage(derived_rows(scans, cast, latitude, saar, size), "derived")
    alive = rows.where("processed")
    marks = layers.cast_marks(alive, cast, order)
    n2 = layers.n2_nearest(alive, layers.n2_pairs(alive, cast, order, size), cast, order, size, n is not None)
    out = layers.with_n2(rows, n2, cast, order, size, n is not None).join(marks, cast, "left")
    out = layers.with_oxygen(out).withColumn(
        "is_downcast", F.coalesce(F.col(order) <= F.col("downcast_end"), F.lit(False)))
    out = layers.with_vendor_salinity(out, active=F.col("processed"))
    if "ph" in out.columns:
        out = out.withColumn("ph", F.when(F.col("processed"), clean.ph_qc()).otherwise(F.col("ph")))
    out = out.withColumns({c: F.when(F.col("processed"), F.col(c)) for c in DERIVED})
    if "depth_m" not in scans.columns:
        out = out.withColumn("depth_m", F.when(F.col("processed"), F.col("depth_m")))
    return out.drop("_SA", "_CT", "downcast_end")


def process_for_sink(scans, entries, by, cast="cast_id", order="scan"):
    """Level2 rows of the casts that ``entries`` name, with the columns of these, lying as a sink by ``by`` wants them: a partition
    holds whole casts that follow each other by ``by`` and name. For casts that fit a task (``chunk_size`` None).

    A level table wants the casts of a folder together. They are put there by the one shuffle of scans that cleaning needs, before
    the rows grow to more than twice as many bytes, and neither they nor Level2 are moved or written once more.
    """
    held = scans.groupBy(cast).agg(F.count("*").alias("_held"))
    first = entries.groupBy(cast).agg(F.min(F.struct(*by)).alias("_by")).select(cast, "_by.*")
    rows = min(sequence.BUCKET_ROWS, tables.file_rows(scans))
    keys, n = sequence.deal_keys(held.join(first, cast), by, cast, rows)
    few = keys.count() <= MOST_KEYS
    dealt = process_casts(scans.join(F.broadcast(keys) if few else keys, cast), "_deal", order, size=None, buckets=n)
    # The entries lie in the same buckets, so they meet the rows where these are.
    sited = save_buckets(entries.join(keys, cast).drop(cast).repartition(n, "_deal"), "entries", "_deal", n)
    return dealt.join(sited, "_deal").drop("_deal")


def segment_profiles(scans, cast="cast_id", order="scan", size=0):
    """Scans with segment number, range and profile name; a bound two segments share appears in both."""
    size = sequence.chunk_size(scans, [cast]) if size == 0 else size
    bounds = segment.segment_bounds(scans, cast, order, size=size)
    parts = save_stage(segment.segments(scans, bounds, cast, order, size), "segments")
    named = segment.profile_names(scans, parts, cast, order)
    return segment.segment_profiles(scans, named, cast, order)


def process_segments(scans, cast="cast_id", order="scan", size=0):
    """Segment mode: split, then process every segment as a cast of its own (key ``profile_id``)."""
    size = sequence.chunk_size(scans, [cast]) if size == 0 else size
    parts = segment_profiles(scans, cast, order, size)
    parts = parts.withColumn("profile_id", F.concat_ws("_", cast, (F.col("segment") + 1).cast("string")))
    return process_casts(parts, "profile_id", order, size=size)


def concat_daily(scans, cast="cast_id", order="scan", modified=None):
    """All scans of one day and instrument as one cast: key ``group_id``, new ``scan`` in time order.

    Rows without ``datetime`` follow in depth order. A day may hold most of the data, so the numbering is a range sort.
    """
    groups = reports.daily_groups(scans, cast, order, modified).select(cast, "cast_date")
    rows = scans.join(groups, cast)
    day = F.date_format("cast_date", "yyyy-MM-dd")
    rows = rows.withColumn("group_id", F.concat_ws("_", day, "ctd_type", F.lit("concatenated")))
    depth = F.col("depth_m") if "depth_m" in rows.columns else F.lit(None).cast("double")
    rows = rows.withColumnRenamed(order, "source_scan").withColumn(
        "_depth", F.when(F.col("datetime").isNull(), depth))
    clock = [F.col("datetime").asc_nulls_last(), F.col("_depth").asc_nulls_last()]
    return sequence.number_rows(rows, ["group_id"], [*clock, cast, "source_scan"], order, "daily", sequence.WHOLE_LIMIT).drop("_depth")


def process_daily(scans, cast="cast_id", order="scan", modified=None, size=0):
    """Concatenate mode: daily groups, each processed as one cast."""
    return process_casts(concat_daily(scans, cast, order, modified), "group_id", order, size=size)


def organise_stations(profiles, rows, entries, raw_files=None, key="path"):
    """Matched profiles by station: dict of ``matches``, ``rows`` (with campaign and Station), the two leftovers, the
    summary, and ``files``: which file goes to which station's folder, with ``raw_files`` also the related raw files.

    Rows are placed by the ``path`` of the profile they belong to, so one file name in two campaigns stays two profiles.
    """
    matches = stations.logbook_prefix(profiles, entries).withColumn("campaign", F.coalesce("campaign", F.lit("")))
    placed = matches.select(F.col("path").alias(key), "campaign", "Station").distinct()
    related = stations.related_files(matches, raw_files) if raw_files is not None else None
    return {
        "matches": matches,
        "rows": rows.drop("campaign", "Station").join(placed, key),
        "unmatched_profiles": stations.unmatched_profiles(profiles, matches),
        "unmatched_entries": stations.unmatched_entries(entries, matches),
        "summary": stations.match_summary(profiles, matches),
        "files": stations.station_files(matches, related),
    }


def ingest_tree(spark, root, convert_units=False):
    """Every cast file under a folder -> Level1 scans of all instruments, plus the table of rejected files and why.

    The text of the tree is scanned once, whatever its encoding; the readers share the numbered lines. A GF23 file belongs
    to the activity log of its own or the nearest upper folder, an RBR file to the unit list that its name and folder
    choose. ``modified`` is the file's time. A file that a reader takes but finds no row in is rejected too.
    """
    listing = save_stage(files.classify(files.file_manifest(spark, root, (*files.CAST_EXTENSIONS, ".json"))), "classified")
    # What a file is follows from its path alone, so it is found once per file and its lines carry it.
    name = F.lower("path")
    comma = name.endswith(".csv") | name.endswith(".txt") & name.contains("_data")
    lines = files.file_lines(listing.withColumns({
        "comma": comma, "log": comma & (F.lower(base_name(F.col("path"))) == tables.ACTIVITY_LOG), "side": tables.is_sidecar()}), ("ctd_type", "comma", "log", "side"))
    listing = files.with_extensions(listing)
    kinds = listing.where("ctd_type IS NOT NULL").select("path", "ctd_type")
    commas = files.csv_records(lines.where("comma"))

    def mine(kind, source=lines):
        return source.where(F.col("ctd_type") == kind).drop("ctd_type", "comma", "log", "side")

    log = instruments.activity_log(tables.activity_rows(commas.where("log")))
    logged = tables.nearest_folder(kinds.where("ctd_type = 'gf23'"), log)
    units = tables.unit_table(kinds.where("ctd_type = 'rbr'"), tables.sidecar_texts(lines.where("side")))
    scans = tables.combine([
        instruments.ingest_idronaut(mine("idronaut")), instruments.ingest_seabird(mine("seabird")),
        instruments.ingest_gf23(mine("gf23"), log, logged), instruments.ingest_exo(mine("exo", commas)),
        instruments.ingest_rbr(mine("rbr", commas), units, convert_units)])
    scans = save_stage(scans.withColumns({"cast_id": F.col("path"), "source_file": base_name(F.col("path"))}), "ingested")
    empty = listing.where("ctd_type IS NOT NULL").join(scans.select("path").distinct(), "path", "left_anti").withColumn("reason", F.lit("no rows"))
    return scans, files.rejected(listing).unionByName(empty)


def process_tree(spark, root, level1=None, level2=None, mode=None, latitude=schema.SITE_LATITUDE, form="parquet"):
    """Files -> Level1 -> Level2: the batch over a folder of raw files.

    ``mode``: None (a file is a cast), ``segment`` (a file is split into casts) or ``concatenate`` (a day's files of one
    instrument are one cast). Returns the dict ``level1, level2, rejected, key``; with ``level1`` and ``level2`` paths the
    tables are written there too, under the folder (campaign) that a file lies in.
    """
    scans, rejected = ingest_tree(spark, root)
    if mode == "segment":
        first = segment_profiles(scans).withColumn("cast_id", F.concat_ws("_", "cast_id", (F.col("segment") + 1).cast("string")))
    elif mode == "concatenate":
        first = concat_daily(scans, modified="modified").withColumn("cast_id", F.col("group_id"))
    else:
        first = scans
    first = save_stage(first.withColumn("campaign", base_name(directory(F.col("path")))), "level1")
    second = process_casts(first, latitude=latitude)
    if level1:
        tables.write_profiles(first, level1, form=form)
    if level2:
        second = save_stage(second, "level2")
        tables.write_profiles(second, level2, form=form)
    return {"level1": first, "level2": second, "rejected": rejected}


def export_a2ps(rows, path, form="split", profile="cast_id", order="scan", clock="timestamp"):
    """Layout files of every profile of a Level2 table, and the table read back from them.

    ``form``: ``split`` (downward and upward file), ``whole`` (one row per pressure) or ``clock`` (every row, with clock
    columns, in scan order). Profiles whose exported mean oxygen is negative are in ``warnings``.
    """
    layouts = {"split": export.a2ps_split, "whole": export.a2ps_whole}
    if form == "clock":
        layout, sort, direction = export.a2ps_clock(rows, profile, order, clock), order, None
    else:
        layout, sort, direction = layouts[form](rows, profile, order), "PrdE", "direction" if form == "split" else None
    layout = save_stage(layout, "layout")
    tables.write_layout(layout, path, profile, direction, sort, keep_sort=form != "clock")
    keys = [profile, *([direction] if direction else [])]
    return {"files": tables.read_layout(rows.sparkSession, path), "warnings": export.oxygen_warnings(layout, keys)}
