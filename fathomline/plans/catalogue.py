"""The query catalogue: each entry is a Spark job over the driver's tables and the SQL it is checked against."""

from pyspark.sql import functions as F

from fathomline import fixtures, schema
from fathomline.functions import seawater, text
from fathomline.operators import clean, export, layers, reports, segment, sequence, stations
from fathomline.plans import jobs, raw_tree
from fathomline.plans import oracles as o
from fathomline.session import tune
from fathomline.sources import files, instruments, tables
from fathomline.storage import stage_path

QUERIES = {}
SQL = {}


def query(name, sql=None):
    """Register a job under ``name`` with its SQL."""
    def add(build):
        QUERIES[name] = lambda spark, sf_dir: build(tune(spark), sf_dir)
        if sql:
            SQL[name] = sql
        return build
    return add


def rounded(df, digits=6, **special):
    """Doubles rounded for comparison; 0.0 added so that no negative zero is left.

    A mean over few readings of four decimals would fall on a rounding tie at six digits, hence eight for air PAR; psi
    values have at most ten decimals.
    """
    special = {"PAR_avg_air": 8, "PrdE": 10, **special}
    return df.withColumns({c: F.round(c, special.get(c, digits)) + 0.0 for c, t in df.dtypes if t == "double"})


def level1(spark, sf_dir):
    return fixtures.level1(spark, sf_dir)


_SIZES = {}


def size_of(spark, sf_dir):
    """Chunk size for the Level1 table, measured once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SIZES:
        _SIZES[key] = sequence.chunk_size(level1(spark, sf_dir), ["cast_id"])
    return _SIZES[key]


def processed(spark, sf_dir):
    """Level2: the processed casts, written once per session like the Level1 table they come from."""
    return fixtures.once(spark, sf_dir, "level2", lambda: jobs.process_casts(
        level1(spark, sf_dir), size=size_of(spark, sf_dir)))


def water(spark, sf_dir):
    """Cleaned rows of casts that have water, with salinity, temperatures and density."""
    return fixtures.once(spark, sf_dir, "water", lambda: jobs.derived_rows(
        level1(spark, sf_dir), size=size_of(spark, sf_dir)).where("processed"))


def cast_entries(spark, sf_dir):
    return fixtures.logbook(spark, sf_dir).select(
        F.concat(F.lit("cast_"), F.col("entry_no").cast("string")).alias("cast_id"), "Station", "station_ODV", "Latitude",
        "Longitude", F.coalesce("campaign", F.lit("none")).alias("campaign"))


def summary_columns(rows):
    """Depth and pressure keep six decimals, as in the CSV hand-over."""
    clock = F.coalesce("timestamp", "datetime")
    return rows.withColumns({
        "datetime": clock, "date": clock.cast("date"), "profile_name": F.col("cast_id"),
        "depth_m": F.round("depth_m", 6), "pressure_dbar": F.round("pressure_dbar", 6)})


def combined(spark, sf_dir):
    """Level2 with its stations: what the summaries read."""
    return summary_columns(processed(spark, sf_dir)).join(cast_entries(spark, sf_dir), "cast_id")


def combined_for_sink(spark, sf_dir):
    """The rows of ``combined`` for a table by campaign, and whether they lie as its files should."""
    if size_of(spark, sf_dir) is not None:
        return combined(spark, sf_dir), False
    key = (spark.sparkContext.applicationId, sf_dir, "for-sink")
    if key not in fixtures._TABLES:
        fixtures._TABLES[key] = jobs.process_for_sink(level1(spark, sf_dir), cast_entries(spark, sf_dir), ["campaign"])
    rows = summary_columns(fixtures._TABLES[key])
    named = [c for c in cast_entries(spark, sf_dir).columns if c != "cast_id"]
    return rows.select(*[c for c in rows.columns if c not in named], *named), True


def stamp(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


# ---- sources -------------------------------------------------------------------------------------------------------

@query("file_manifest", o.q(o.FILES, "SELECT path FROM files WHERE regexp_matches(lower(path), '\\.(cnv|txt|csv)$')"))
def _(spark, sf_dir):
    return files.with_extensions(fixtures.raw_files(spark, sf_dir)).select("path")


@query("classify_instrument", o.q(o.FILES, """
SELECT path, CASE WHEN extension = '.cnv' THEN 'seabird' WHEN extension = '.txt' AND lower(path) LIKE '%idronaut%' THEN 'idronaut'
  WHEN extension = '.txt' AND lower(path) LIKE '%\\_data%' ESCAPE '\\' AND lower(directory) LIKE '%rbr%' THEN 'rbr'
  WHEN extension = '.csv' AND lower(path) LIKE '%kor%' THEN 'exo'
  WHEN extension = '.txt' AND base_name LIKE '%.TXT%' THEN 'gf23' END AS ctd_type FROM parts"""))
def _(spark, sf_dir):
    return files.classify(fixtures.raw_files(spark, sf_dir)).select("path", "ctd_type")


@query("rejected_files", o.q(o.FILES, """
SELECT path, CASE WHEN path LIKE '%suboceanexperiment%' THEN 'subocean' ELSE 'unknown instrument' END AS reason
FROM parts WHERE extension = '.pdf' OR path LIKE '%suboceanexperiment%'"""))
def _(spark, sf_dir):
    return files.rejected(files.classify(fixtures.raw_files(spark, sf_dir))).select("path", "reason")


@query("path_parts", o.q(o.FILES, "SELECT path, directory, base_name, stem, extension FROM parts"))
def _(spark, sf_dir):
    return files.path_parts(fixtures.raw_files(spark, sf_dir)).select(
        "path", "directory", "base_name", "stem", "extension")


def vendor_lines(spark, sf_dir, kind, head, row):
    """A vendor's text made from the scans: header lines and one line per scan, never a whole file in one value."""
    scans = level1(spark, sf_dir).where(F.col("ctd_type") == kind)
    path = F.concat(F.lit("raw/"), "source_file")
    heads = scans.where("scan = 0").select(path.alias("path"), F.posexplode(F.array(*map(F.lit, head))).alias("n", "line"))
    body = scans.select(path.alias("path"), (F.col("scan") + len(head)).alias("line_no"), row.alias("line"))
    return heads.select("path", F.col("n").cast("bigint").alias("line_no"), "line").unionByName(body)


def cell(column, scale=1.0):
    value = F.col(column) if scale == 1.0 else F.col(column) * scale
    return F.coalesce(value.cast("string"), F.lit("NaN"))


IDRONAUT_HEAD = ["Date Time Pres Temp Cond Sal O2% PAR pH", "[d] [t] [dbar] [C] [mS/m] [PSU] [%] [umol] [-]"]


def idronaut_lines(spark, sf_dir):
    return vendor_lines(spark, sf_dir, "idronaut", IDRONAUT_HEAD, F.concat_ws(
        " ", F.date_format("datetime", "MM-dd-yyyy HH:mm:ss.SSS"), cell("pressure_dbar"), cell("temperature_C"),
        cell("conductivity_mS_per_m"), cell("salinity_psu"), cell("oxygen_saturation_percent"), cell("PAR_umol_m2_s"),
        cell("ph")))


INGESTED = """SELECT 'raw/' || source_file AS path, scan, {cols} FROM scans WHERE ctd_type = '{kind}'"""


@query("ingest_idronaut", o.q(o.SCANS, INGESTED.format(kind="idronaut", cols=o.rounded(
    "pressure_dbar temperature_C conductivity_mS_per_m salinity_psu oxygen_saturation_percent PAR_umol_m2_s")
    + ", round(ph, 6) AS ph_raw, 'dbar' AS pressure_unit, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS clock")))
def _(spark, sf_dir):
    rows = instruments.ingest_idronaut(idronaut_lines(spark, sf_dir))
    raw_ph = F.col("extras")["pH"].try_cast("double")
    return rounded(rows.select(
        "path", "scan", "pressure_dbar", "temperature_C", "conductivity_mS_per_m", "salinity_psu",
        "oxygen_saturation_percent", "PAR_umol_m2_s", F.when(~F.isnan(raw_ph), raw_ph).alias("ph_raw"),
        F.col("units")["Pres"].alias("pressure_unit"), stamp("datetime").alias("clock")))


def seabird_lines(spark, sf_dir):
    names = ["scan: Scan Count", "prdM: Pressure [db]", "t090C: Temperature", "c0S/m: Conductivity", "sal00: Salinity",
             "sbeox0PS: Oxygen", "ph: pH", "wetCDOM: CDOM", "flag: flag"]
    head = ["* Sea-Bird data file", *[f"# name {i} = {n}" for i, n in enumerate(names)], "*END*"]
    return vendor_lines(spark, sf_dir, "seabird", head, F.concat_ws(
        " ", F.col("scan").cast("string"), cell("pressure_dbar"), cell("temperature_C"),
        cell("conductivity_mS_per_m", 0.001), cell("salinity_psu"), cell("oxygen_saturation_percent"), cell("ph"),
        cell("PAR_umol_m2_s"), F.lit("0.0000e+00")))


@query("ingest_seabird", o.q(o.SCANS, INGESTED.format(kind="seabird", cols=o.rounded(
    "pressure_dbar temperature_C conductivity_mS_per_m salinity_psu oxygen_saturation_percent ph")
    + ", round(PAR_umol_m2_s, 6) AS cdom, 0.0 AS flag")))
def _(spark, sf_dir):
    rows = instruments.ingest_seabird(seabird_lines(spark, sf_dir))
    return rounded(rows.select("path", "scan", "pressure_dbar", "temperature_C", "conductivity_mS_per_m", "salinity_psu",
                               "oxygen_saturation_percent", "ph",
                               F.col("extras")["wetCDOM"].try_cast("double").alias("cdom"), "flag"))


def gf23_lines(spark, sf_dir):
    scans = level1(spark, sf_dir)
    zero = F.lit("0.0")
    lines = vendor_lines(spark, sf_dir, "gf23", ["GF23 profile", "Depth Temp ..."], F.concat_ws(
        " ", zero, F.concat(cell("temperature_C"), F.lit("**")), cell("conductivity_mS_per_m"),
        cell("oxygen_saturation_percent"), zero, cell("ph"), cell("PAR_umol_m2_s"), cell("salinity_psu"), zero,
        zero, cell("pressure_dbar")))
    return lines


def activity_raw(spark, sf_dir):
    """Activity log text: one CTD entry per cast station and one that is no CTD; latitude IN blank for every third."""
    book = fixtures.logbook(spark, sf_dir)
    k = F.col("entry_no")

    def dms(degrees, minutes):
        return F.concat(degrees, F.lit("°"), minutes, F.lit("'"))

    minutes = F.concat((k % 50).cast("string"), F.lit(",5"))
    latitude = dms(F.lit("60"), minutes)
    day = F.when(k % 2 == 0, F.concat(F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit(".07.24"))).otherwise(
        F.concat(F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit(".07.2024")))
    return book.select(
        F.explode(F.array(F.lit("CTD"), F.lit("NET"))).alias("Activity"),
        F.concat(F.lit("cast_"), k.cast("string")).alias("station_ID"), "station_ODV", day.alias("date"),
        F.when(k % 3 != 0, latitude).alias("lat IN"), latitude.alias("lat OUT"), dms(F.lit("45"), minutes).alias("long IN"),
        F.lit("09:30").alias("time In"))


ACTIVITY = """
activity AS (
  SELECT 'cast_' || s_suppkey AS Station, CAST(s_suppkey % 40 + 1 AS DOUBLE) AS station_ODV,
    make_date(2024, 7, CAST(s_suppkey % 28 + 1 AS INTEGER)) AS date, 60 + ((s_suppkey % 50) + 0.5) / 60 AS Latitude,
    -(45 + ((s_suppkey % 50) + 0.5) / 60) AS Longitude, '09:30' AS time
  FROM supplier)"""


def activity(spark, sf_dir):
    """The log as a CSV file in the shared folder, read back and cleaned."""
    def build():
        path = stage_path(spark, "activity_log")
        activity_raw(spark, sf_dir).write.option("header", True).csv(path)
        return instruments.activity_log(spark.read.option("header", True).csv(path))
    return fixtures.once(spark, sf_dir, "activity", build)


@query("activity_log", o.q(ACTIVITY, f"SELECT Station, {o.rounded('station_ODV Latitude Longitude', 8)}, "
                                     "strftime(date, '%Y-%m-%d') AS date, time FROM activity"))
def _(spark, sf_dir):
    return rounded(activity(spark, sf_dir).select(
        "Station", "station_ODV", "Latitude", "Longitude", F.date_format("date", "yyyy-MM-dd").alias("date"), "time"), 8)


@query("ingest_gf23", o.q(o.SCANS + "," + ACTIVITY, f"""
SELECT 'raw/' || source_file AS path, scan, {o.rounded("pressure_dbar temperature_C conductivity_mS_per_m salinity_psu "
"oxygen_saturation_percent ph PAR_umol_m2_s")}, Station, {o.rounded("Latitude Longitude", 8)},
strftime(date, '%Y-%m-%d') || ' 09:30:00' AS clock
FROM scans JOIN activity ON Station = cast_id WHERE ctd_type = 'gf23'"""))
def _(spark, sf_dir):
    rows = instruments.ingest_gf23(gf23_lines(spark, sf_dir), activity(spark, sf_dir))
    return rounded(rows.select(
        "path", "scan", "pressure_dbar", "temperature_C", "conductivity_mS_per_m", "salinity_psu",
        "oxygen_saturation_percent", "ph", "PAR_umol_m2_s", "Station", "Latitude", "Longitude",
        stamp("datetime").alias("clock")), Latitude=8, Longitude=8)


@query("join_activity_log", o.q(o.SCANS + "," + ACTIVITY, f"""
SELECT cast_id, scan, {o.rounded("pressure_dbar")}, {o.rounded("station_ODV Latitude Longitude", 8)}
FROM scans LEFT JOIN activity ON Station = cast_id"""))
def _(spark, sf_dir):
    scans = level1(spark, sf_dir).select("cast_id", "scan", "pressure_dbar", F.col("cast_id").alias("Station"))
    log = activity(spark, sf_dir).select("Station", "station_ODV", "Latitude", "Longitude")
    return rounded(stations.with_activity_log(scans, log).drop("Station"), 8)


def exo_lines(spark, sf_dir):
    head = ["KOR export", *[f"preamble {i}" for i in range(8)],
            "DATE (MM/DD/YYYY),TIME (HH:MM:SS),COND µS/CM,SAL PSU,PRESSURE PSI A,ODO % SAT,PH,TEMP °C,Battery V"]
    return vendor_lines(spark, sf_dir, "exo", head, F.concat_ws(
        ",", F.date_format("datetime", "MM/dd/yyyy"), F.date_format("datetime", "HH:mm:ss"),
        cell("conductivity_mS_per_m", 10.0), cell("salinity_psu"), cell("pressure_dbar"),
        cell("oxygen_saturation_percent"), cell("ph"), cell("temperature_C"), cell("PAR_umol_m2_s")))


@query("ingest_exo", o.q(o.SCANS, INGESTED.format(kind="exo", cols=o.rounded(
    "temperature_C conductivity_mS_per_m salinity_psu oxygen_saturation_percent ph")
    + ", round(pressure_dbar * 0.689476, 8) AS pressure_dbar, round(PAR_umol_m2_s, 6) AS battery,"
      " strftime(datetime, '%Y-%m-%d %H:%M:%S') AS clock")))
def _(spark, sf_dir):
    rows = instruments.ingest_exo(exo_lines(spark, sf_dir))
    return rounded(rows.select(
        "path", "scan", "pressure_dbar", "temperature_C", "conductivity_mS_per_m", "salinity_psu",
        "oxygen_saturation_percent", "ph", F.col("extras")["Battery V"].try_cast("double").alias("battery"),
        stamp("datetime").alias("clock")), pressure_dbar=8)


def rbr_lines(spark, sf_dir):
    head = ["Time,Conductivity,Temperature,Pressure,Temperature,Dissolved O2 saturation,Salinity,"
            "Dissolved O2 concentration,Specific conductivity,Bottle number"]
    return vendor_lines(spark, sf_dir, "rbr", head, F.concat_ws(
        ",", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSS"), cell("conductivity_mS_per_m"), cell("temperature_C"),
        cell("pressure_dbar"), cell("ph"), cell("oxygen_saturation_percent"), cell("salinity_psu"),
        cell("oxygen_saturation_percent"), cell("conductivity_mS_per_m"), F.lit("bad")))


RBR_COLUMNS = """{r}, round(ph, 6) AS temperature_secondary_C,
round(oxygen_saturation_percent, 6) AS oxygen_concentration_ml_per_L,
round(conductivity_mS_per_m * 0.1, 8) AS conductivity_specific_mS_per_m,
strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS clock, 'bad' AS bottle"""


@query("ingest_rbr", o.q(o.SCANS, INGESTED.format(kind="rbr", cols=RBR_COLUMNS.format(r=o.rounded(
    "pressure_dbar temperature_C conductivity_mS_per_m salinity_psu oxygen_saturation_percent")))))
def _(spark, sf_dir):
    rows = instruments.ingest_rbr(rbr_lines(spark, sf_dir))
    return rounded(rows.select(
        "path", "scan", "pressure_dbar", "temperature_C", "conductivity_mS_per_m", "salinity_psu",
        "oxygen_saturation_percent", "temperature_secondary_C", "oxygen_concentration_ml_per_L",
        "conductivity_specific_mS_per_m", stamp("timestamp").alias("clock"),
        F.col("extras")["Bottle_number"].alias("bottle")), conductivity_specific_mS_per_m=8)


def rbr_files(spark, sf_dir):
    """RBR data files and unit lists: by ``cast_no % 3`` a text list, a JSON list, or only the folder's first JSON."""
    k = F.col("s_suppkey")
    rbr = fixtures.table(spark, sf_dir, "supplier").where(k % 5 == 2).select(
        k, F.format_string("rbr/%d/cast_%d", k % 10, k).alias("base"))
    data = rbr.select(F.concat("base", F.lit("_data.txt")).alias("path"))
    unit = F.when(k % 4 == 0, "mS/cm").otherwise("mS/m")
    content = F.concat(F.lit('{"dataheader":[{"name":"Conductivity","units":"'), unit,
                       F.lit('"},{"name":"Dissolved O2 concentration","units":"umol/L"},{"name":"Depth"}]}'))
    side = rbr.where(k % 3 != 2).select(F.concat("base", F.when(k % 3 == 0, "_metadata.txt").otherwise(
        "_metadata.json")).alias("path"), content.alias("text"))
    return data, side


RBR_FILES = """
rbr AS (SELECT s_suppkey AS k, 'rbr/' || (s_suppkey % 10) || '/cast_' || s_suppkey AS base FROM supplier WHERE s_suppkey % 5 = 2),
side AS (SELECT k, base || CASE WHEN k % 3 = 0 THEN '_metadata.txt' ELSE '_metadata.json' END AS sp,
         CASE WHEN k % 4 = 0 THEN 'mS/cm' ELSE 'mS/m' END AS cu FROM rbr WHERE k % 3 <> 2),
ju AS (SELECT k % 10 AS dir, arg_min(cu, sp) AS cu FROM side WHERE sp LIKE '%.json' GROUP BY 1),
units AS (SELECT rbr.k, base || '_data.txt' AS path, coalesce(side.cu, ju.cu) AS cu FROM rbr LEFT JOIN side USING (k)
          LEFT JOIN ju ON ju.dir = rbr.k % 10)"""


@query("rbr_units", o.q(RBR_FILES, "SELECT path, cu AS conductivity_unit, 'umol/L' AS oxygen_unit FROM units "
                                   "WHERE cu IS NOT NULL"))
def _(spark, sf_dir):
    return tables.unit_table(*rbr_files(spark, sf_dir)).select(
        "path", F.col("units")["Conductivity"].alias("conductivity_unit"),
        F.col("units")["Dissolved O2 concentration"].alias("oxygen_unit"))


@query("unit_convert_meta", o.q(o.SCANS + "," + RBR_FILES, """
SELECT cast_id, scan, round(CASE WHEN cu = 'mS/cm' THEN conductivity_mS_per_m * 100 ELSE conductivity_mS_per_m END, 6) AS conductivity_mS_per_m,
  round(CASE WHEN cu IS NULL THEN oxygen_saturation_percent ELSE oxygen_saturation_percent / 44.661 END, 8) AS oxygen_concentration_ml_per_L
FROM scans JOIN units ON k = cast_no"""))
def _(spark, sf_dir):
    units = tables.unit_table(*rbr_files(spark, sf_dir)).select(text.stem(F.col("path")).alias("path"), "units")
    rows = instruments.ingest_rbr(rbr_lines(spark, sf_dir)).withColumn(
        "path", F.concat(text.stem(F.col("path")), F.lit("_data")))
    rows = instruments.convert_by_units(rows.join(units, "path", "left"))
    return rounded(rows.select(
        F.regexp_replace("path", "_data$", "").alias("cast_id"), "scan", "conductivity_mS_per_m",
        "oxygen_concentration_ml_per_L"), oxygen_concentration_ml_per_L=8)


# ---- files on disk -------------------------------------------------------------------------------------------------

def raw_files_tree(spark, sf_dir):
    return written(spark, sf_dir, "raw-tree", lambda _: raw_tree.write_raw_tree(
        spark, sf_dir, idronaut_lines(spark, sf_dir), seabird_lines(spark, sf_dir), rbr_lines(spark, sf_dir),
        exo_lines(spark, sf_dir), gf23_lines(spark, sf_dir), activity_raw(spark, sf_dir)))


def ingested(spark, sf_dir):
    """The tree read back once per session: ``(root, scans, rejected)``."""
    key = (spark.sparkContext.applicationId, sf_dir, "ingested-tree")
    if key not in fixtures._TABLES:
        root = raw_files_tree(spark, sf_dir)
        fixtures._TABLES[key] = (root, *jobs.ingest_tree(spark, root))
    return fixtures._TABLES[key]


def in_tree(path, root):
    """The part of a path below the tree's root."""
    return F.element_at(F.split(path, root.rsplit("/", 1)[1] + "/"), -1)


TREE_FILE = """CASE cast_no % 2 WHEN 0 THEN 'north field/' ELSE 'süd 2/' END || CASE ctd_type
  WHEN 'idronaut' THEN 'idro/' || cast_id || '_Idronaut.txt' WHEN 'seabird' THEN 'sb/' || cast_id || '.CNV'
  WHEN 'rbr' THEN 'RBR/' || cast_id || '_data.txt' WHEN 'exo' THEN 'exo/KOR ' || cast_id || '.CSV' ELSE 'gf/' || cast_id || '.TXT' END"""


@query("ingest_files", o.q(o.SCANS + "," + ACTIVITY, f"""
SELECT {TREE_FILE} AS file, ctd_type, scan, {o.rounded("temperature_C conductivity_mS_per_m salinity_psu")},
  round(pressure_dbar * CASE ctd_type WHEN 'exo' THEN 0.689476 ELSE 1 END, 8) AS pressure_dbar,
  round(CASE WHEN ctd_type <> 'rbr' THEN ph END, 6) AS ph,
  CASE WHEN ctd_type <> 'rbr' THEN NULL WHEN cast_no % 3 <> 2 THEN CASE cast_no % 4 WHEN 0 THEN 'mS/cm' ELSE 'mS/m' END
    WHEN EXISTS (SELECT 1 FROM supplier WHERE s_suppkey % 5 = 2 AND s_suppkey % 3 <> 2 AND s_suppkey % 2 = cast_no % 2) THEN 'decoy' END AS unit,
  CASE ctd_type WHEN 'gf23' THEN cast_id END AS station,
  CASE ctd_type WHEN 'gf23' THEN round(Latitude, 8) END AS latitude,
  CASE ctd_type WHEN 'gf23' THEN round(Longitude - cast_no % 2, 8) END AS longitude,
  CASE ctd_type WHEN 'gf23' THEN strftime(date, '%Y-%m-%d') || ' 09:30:00' WHEN 'seabird' THEN NULL
    ELSE strftime(coalesce(timestamp, datetime), '%Y-%m-%d %H:%M:%S') END AS clock, true AS dated
FROM scans JOIN activity ON Station = cast_id"""))
def _(spark, sf_dir):
    root, scans, _ = ingested(spark, sf_dir)
    return rounded(scans.select(
        in_tree("path", root).alias("file"), "ctd_type", "scan", "pressure_dbar", "temperature_C", "conductivity_mS_per_m", "salinity_psu",
        "ph", F.when(F.col("ctd_type") == "rbr", F.col("units")["Conductivity"]).alias("unit"), F.col("Station").alias("station"),
        F.col("Latitude").alias("latitude"), F.col("Longitude").alias("longitude"),
        stamp(F.coalesce("timestamp", "datetime")).alias("clock"), F.col("modified").isNotNull().alias("dated")),
        pressure_dbar=8, latitude=8, longitude=8)


@query("ingest_rejects", o.q(RBR_FILES, """
SELECT 'north field/activity_log_ODV.csv' AS file, 'unknown instrument' AS reason UNION ALL
SELECT 'süd 2/Activity_Log_ODV.CSV', 'unknown instrument' UNION ALL SELECT 'süd 2/notes.csv', 'unknown instrument' UNION ALL
SELECT 'north field/suboceanexperiment_1.txt', 'subocean' UNION ALL SELECT 'süd 2/exo/KOR empty.csv', 'no rows' UNION ALL
SELECT CASE k % 2 WHEN 0 THEN 'north field/' ELSE 'süd 2/' END || 'RBR/cast_' || k || '_metadata.txt', 'unknown instrument'
FROM side WHERE sp LIKE '%.txt'"""))
def _(spark, sf_dir):
    root, _, rejected = ingested(spark, sf_dir)
    return rejected.select(in_tree("path", root).alias("file"), "reason")


@query("nearest_logs", o.q(o.SCANS, f"""
SELECT DISTINCT {TREE_FILE} AS file, CASE cast_no % 2 WHEN 0 THEN 'north field' ELSE 'süd 2' END AS folder FROM scans"""))
def _(spark, sf_dir):
    # Every cast file of the tree, whatever its instrument: its log lies one folder up.
    root = raw_files_tree(spark, sf_dir)
    listing = files.classify(files.file_manifest(spark, root))
    logs = listing.where(F.lower("path").endswith("activity_log_odv.csv")).select(text.directory(F.col("path")).alias("folder"))
    casts = listing.where("ctd_type IS NOT NULL AND path NOT LIKE '%KOR empty.csv'")
    return tables.nearest_folder(casts, logs).select(
        in_tree("path", root).alias("file"), in_tree("folder", root).alias("folder"))


@query("logbook_scan", o.q(o.LOGBOOK, "SELECT entry_no, Station, campaign, ctd_file, subocean_file FROM logbook"))
def _(spark, sf_dir):
    def build():
        path = stage_path(spark, "logbook")
        fixtures.logbook(spark, sf_dir).withColumnsRenamed(
            {"ctd_file": "CTD file", "subocean_file": "Subocean File", "exo_file": "Exo file", "exo_file_2": "Exo file 2"}
        ).write.option("sep", ";").option("header", True).csv(path)
        return tables.read_logbook(spark, path)
    return fixtures.once(spark, sf_dir, "logbook", build).select(
        F.col("entry_no").cast("bigint").alias("entry_no"), "Station", "campaign", "ctd_file", "subocean_file")


# ---- columns -------------------------------------------------------------------------------------------------------

@query("standardize_columns", o.q(o.SCANS, f"""
SELECT cast_id, scan, {o.rounded("pressure_dbar temperature_C")}, round(salinity_psu, 6) AS salinity_psu, 1 AS n_extras
FROM scans WHERE ctd_type = 'exo'"""))
def _(spark, sf_dir):
    # Other spelling of the same header: matched in any case.
    lines = exo_lines(spark, sf_dir).withColumn("line", F.when(F.col("line_no") == 9, F.lower("line")).otherwise(
        F.col("line")))
    rows = instruments.ingest_exo(lines)
    return rounded(rows.select(text.stem(F.col("path")).alias("cast_id"), "scan",
                               (F.col("pressure_dbar") / 0.689476).alias("pressure_dbar"), "temperature_C",
                               "salinity_psu", F.size("extras").alias("n_extras")))


@query("unit_convert", o.q(o.SCANS, """
SELECT cast_id, scan, ctd_type, round(conductivity_mS_per_m * CASE ctd_type WHEN 'seabird' THEN 1000 WHEN 'exo' THEN 0.1 ELSE 1 END, 6) AS conductivity_mS_per_m,
  round(pressure_dbar * CASE ctd_type WHEN 'exo' THEN 0.689476 ELSE 1 END, 6) AS pressure_dbar FROM scans"""))
def _(spark, sf_dir):
    factors = schema.mapping_table(spark).groupBy("ctd_type").agg(*[
        F.max(F.when(F.col("std_name") == c, F.col("factor"))).alias(f"f_{c}")
        for c in ("conductivity_mS_per_m", "pressure_dbar")])
    rows = level1(spark, sf_dir).join(F.broadcast(factors), "ctd_type")
    return rounded(rows.select("cast_id", "scan", "ctd_type", *[
        (F.col(c) * F.col(f"f_{c}")).alias(c) for c in ("conductivity_mS_per_m", "pressure_dbar")]))


@query("numeric_coerce", """
SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS value
FROM orders""")
def _(spark, sf_dir):
    mixed = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderpriority")).otherwise(
        F.col("o_totalprice").cast("string"))
    return fixtures.table(spark, sf_dir, "orders").select("o_orderkey", mixed.try_cast("double").alias("value"))


def resolve_parameter(asked, mapping):
    """``(ctd_type, param, standardized)`` -> column name: the common table, else the first mapping entry whose standard
    name contains the text. The mapping is a fixed small table, so it is broadcast."""
    common = F.create_map(*[F.lit(v) for pair in schema.COMMON_PARAMETERS.items() for v in pair])
    rows = asked.join(F.broadcast(mapping.withColumnRenamed("ctd_type", "_kind")), (
        F.lower("ctd_type") == F.col("_kind")) & F.lower("std_name").contains(F.lower("param")), "left")
    first = rows.groupBy("asked_no", "ctd_type", "param", "standardized").agg(
        F.min_by("raw_name", "position").alias("raw"), F.min_by("std_name", "position").alias("std"))
    return first.withColumn("column", F.when(~F.col("standardized"), F.col("raw")).otherwise(
        F.coalesce(common[F.col("param")], "std"))).drop("raw", "std")


MAPPING_SQL = "mapping(kind, pos, raw, std) AS (VALUES " + ", ".join(
    f"('{kind}', {i}, '{raw}', '{std}')" for kind, entries in schema.COLUMN_NAMES.items()
    for i, (raw, std, _) in enumerate(entries)) + ")"


@query("resolve_parameter", o.q(MAPPING_SQL + """,
asked AS (SELECT p_partkey AS asked_no,
  CASE p_partkey % 5 WHEN 0 THEN 'idronaut' WHEN 1 THEN 'seabird' WHEN 2 THEN 'RBR' WHEN 3 THEN 'exo' ELSE 'gf23' END AS ctd_type,
  CASE p_size % 6 WHEN 0 THEN 'conductivity' WHEN 1 THEN 'oxygen' WHEN 2 THEN 'PAR' WHEN 3 THEN 'fluorescence' WHEN 4 THEN 'sigma' ELSE 'depth' END AS param,
  p_partkey % 2 = 0 AS standardized FROM part)""", """
SELECT asked_no, ctd_type, param, standardized, CASE WHEN NOT standardized THEN arg_min(raw, pos)
  WHEN param = 'conductivity' THEN 'conductivity_mS_per_m' WHEN param = 'PAR' THEN 'PAR' WHEN param = 'depth' THEN 'depth_m'
  ELSE arg_min(std, pos) END AS "column"
FROM asked LEFT JOIN mapping ON kind = lower(ctd_type) AND contains(lower(std), lower(param))
GROUP BY asked_no, ctd_type, param, standardized"""))
def _(spark, sf_dir):
    k = F.col("p_partkey")
    kinds = F.array(*map(F.lit, ["idronaut", "seabird", "RBR", "exo", "gf23"]))
    params = F.array(*map(F.lit, ["conductivity", "oxygen", "PAR", "fluorescence", "sigma", "depth"]))
    asked = fixtures.table(spark, sf_dir, "part").select(
        k.alias("asked_no"), F.get(kinds, (k % 5).cast("int")).alias("ctd_type"),
        F.get(params, F.col("p_size") % 6).alias("param"), (k % 2 == 0).alias("standardized"))
    return resolve_parameter(asked, schema.mapping_table(spark))


@query("gps_to_degrees", """
SELECT s_suppkey AS entry_no, round(60 + ((s_suppkey % 50) + 0.5) / 60, 8) AS Latitude,
  round(-(45 + ((s_suppkey % 50) + 0.5) / 60), 8) AS Longitude FROM supplier""")
def _(spark, sf_dir):
    k = F.col("s_suppkey")
    mark = F.when(k % 3 == 0, "'").when(k % 3 == 1, "’").otherwise("‘")
    tail = F.concat(F.lit("°"), (k % 50).cast("string"), F.lit(",5"), mark)
    return rounded(fixtures.table(spark, sf_dir, "supplier").select(
        k.alias("entry_no"), text.gps_to_degrees(F.concat(F.lit("60"), tail)).alias("Latitude"),
        (text.gps_to_degrees(F.concat(F.lit("45"), tail)) * -1).alias("Longitude")), 8)


@query("parse_dates", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y-%m-%d') || ' 07:08:09' AS clock
FROM orders""")
def _(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    short = (k % 2 == 0) & (F.year(d) >= 2000)
    raw = F.when(short, F.date_format(d, "dd.MM.yy")).otherwise(F.date_format(d, "dd.MM.yyyy"))
    day = text.day_first_date(raw)
    layout = F.when(k % 3 == 0, F.date_format(d, "MM-dd-yyyy")).when(k % 3 == 1, F.date_format(d, "yyyy-MM-dd")).otherwise(
        F.date_format(d, "MM/dd/yyyy"))
    return fixtures.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("day"),
        stamp(text.clock(layout, F.lit("07:08:09"))).alias("clock"))


# ---- cleaning ------------------------------------------------------------------------------------------------------

CLEAN = o.SCANS + "," + o.clean()


@query("air_water_split", o.q(o.SCANS, """
SELECT cast_id, scan, CASE WHEN conductivity_mS_per_m < t THEN 'air' WHEN conductivity_mS_per_m > t THEN 'water' END AS medium
FROM (SELECT *, CASE WHEN ctd_type = 'exo' THEN 5 ELSE 0.15 END AS t FROM scans)"""))
def _(spark, sf_dir):
    return clean.air_water_split(level1(spark, sf_dir)).select("cast_id", "scan", "medium")


@query("air_offsets", o.q(CLEAN, "SELECT cast_id, n_air, round(p_off, 6) AS pressure_offset, round(o_off, 6) AS oxygen_offset, "
                                 "bad AS bad_air_oxygen, round(PAR_avg_air, 8) AS PAR_avg_air FROM offs"))
def _(spark, sf_dir):
    return rounded(clean.air_offsets(level1(spark, sf_dir), size=size_of(spark, sf_dir)))


@query("air_correct", o.q(CLEAN, "SELECT cast_id, scan, round(p_c, 6) AS pressure_dbar, round(o_c, 6) + 0.0 AS "
                                 "oxygen_saturation_percent, round(par_air, 8) AS PAR_avg_air FROM kept WHERE keep"))
def _(spark, sf_dir):
    rows = clean.apply_keep(clean.air_correct(level1(spark, sf_dir), size=size_of(spark, sf_dir)))
    return rounded(rows.select("cast_id", "scan", "pressure_dbar", "oxygen_saturation_percent", "PAR_avg_air"))


@query("empty_cast_passthrough", o.q(CLEAN, f"SELECT cast_id, scan, processed, {o.rounded('pressure_dbar oxygen_saturation_percent')}, round(PAR_avg_air, 8) AS PAR_avg_air FROM base"))
def _(spark, sf_dir):
    size = size_of(spark, sf_dir)
    rows = clean.with_empty_cast_rows(clean.air_correct(level1(spark, sf_dir), size=size), size=size)
    return rounded(rows.select("cast_id", "scan", "processed", "pressure_dbar", "oxygen_saturation_percent",
                               "PAR_avg_air"))


@query("ph_qc", o.q(o.SCANS, "SELECT cast_id, scan, CASE WHEN ph BETWEEN 6 AND 9 THEN round(ph, 6) END AS ph FROM scans"))
def _(spark, sf_dir):
    return rounded(level1(spark, sf_dir).select("cast_id", "scan", clean.ph_qc().alias("ph")))


@query("qc_report", o.q(CLEAN, """
SELECT cast_id, count(*) AS n_scans, count(*) FILTER (WHERE keep) AS n_kept, coalesce(any_value(n_air), 0) AS n_air,
  any_value(n_air) IS NULL AS no_air_data, coalesce(any_value(bad), FALSE) AS bad_air_oxygen,
  coalesce(avg(o_c) FILTER (WHERE n_air IS NOT NULL AND conductivity_mS_per_m > t) < 0, FALSE) AS negative_corrected_oxygen,
  count(*) FILTER (WHERE keep) = 0 AS no_water_data, coalesce(avg(o_c) FILTER (WHERE keep) < 0, FALSE) AS negative_profile_oxygen,
  count(*) < 21 AS too_short_to_segment
FROM kept LEFT JOIN (SELECT cast_id AS c2, bad FROM offs) ON c2 = cast_id GROUP BY cast_id"""))
def _(spark, sf_dir):
    return clean.qc_report(level1(spark, sf_dir), size=size_of(spark, sf_dir))


@query("downcast_flag", o.q(CLEAN, f"""
SELECT cast_id, scan, scan <= first_deep AS is_downcast FROM (
  SELECT cast_id, scan, min(CASE WHEN dm = mx THEN scan END) OVER (PARTITION BY cast_id) AS first_deep FROM (
    SELECT *, max(dm) OVER (PARTITION BY cast_id) AS mx FROM (
      SELECT cast_id, scan, {o.depth("pressure_dbar")} AS dm FROM base WHERE processed)))"""))
def _(spark, sf_dir):
    rows = clean.apply_keep(clean.air_correct(level1(spark, sf_dir), size=size_of(spark, sf_dir)))
    return layers.with_downcast(layers.with_depth(rows)).select("cast_id", "scan", "is_downcast")


@query("cast_summary", o.q(CLEAN, """
SELECT cast_id, count(*) AS n_kept, round(max(pressure_dbar), 6) AS max_pressure_dbar,
  round(avg(CASE WHEN scan <= deep THEN 1.0 ELSE 0.0 END), 8) AS downcast_share, round(avg(oxygen_saturation_percent), 9) AS avg_oxygen
FROM (SELECT *, min(CASE WHEN pressure_dbar = mx THEN scan END) OVER (PARTITION BY cast_id) AS deep FROM (
  SELECT *, max(pressure_dbar) OVER (PARTITION BY cast_id) AS mx FROM base WHERE processed)) GROUP BY cast_id"""))
def cast_summary(spark, sf_dir):
    """Per cast: scans kept, greatest pressure, share of the downcast, mean corrected oxygen."""
    rows = clean.apply_keep(clean.air_correct(level1(spark, sf_dir), size=size_of(spark, sf_dir)))
    flagged = layers.with_downcast(rows)
    return rounded(flagged.groupBy("cast_id").agg(
        F.count("*").alias("n_kept"), F.max("pressure_dbar").alias("max_pressure_dbar"),
        F.avg(F.when(F.col("is_downcast"), 1.0).otherwise(0.0)).alias("downcast_share"),
        F.avg("oxygen_saturation_percent").alias("avg_oxygen")), downcast_share=8, avg_oxygen=9)


@query("pressure_series", o.q(o.SCANS, """
SELECT strftime(datetime, '%Y-%m-%d %H:%M:%S') AS clock, round(pressure_dbar, 6) AS pressure_dbar FROM scans WHERE cast_id = 'cast_5'"""))
def _(spark, sf_dir):
    return rounded(reports.pressure_series(level1(spark, sf_dir), "cast_5").select(
        stamp("datetime").alias("clock"), "pressure_dbar"))


# ---- seawater ------------------------------------------------------------------------------------------------------

def raw_properties(spark, sf_dir, **columns):
    """The expressions on the scans as they are."""
    return rounded(seawater.with_columns(
        seawater.with_properties(level1(spark, sf_dir)), **columns).select("cast_id", "scan", *columns))


RAW = o.SCANS + "," + o.properties("scans")


@query("depth_from_pressure", o.q(o.SCANS, f"SELECT cast_id, scan, round({o.depth('pressure_dbar')}, 6) AS depth_m FROM scans"))
def _(spark, sf_dir):
    return rounded(layers.with_depth(level1(spark, sf_dir)).select("cast_id", "scan", "depth_m"))


@query("absolute_salinity", o.q(o.SCANS, "SELECT cast_id, scan, round(salinity_psu*35.16504/35, 8) AS sa FROM scans"))
def _(spark, sf_dir):
    return rounded(level1(spark, sf_dir).select(
        "cast_id", "scan", F.expr(seawater.absolute_salinity("salinity_psu")).alias("sa")), 8)


@query("conservative_temp", o.q(RAW, "SELECT cast_id, scan, round(CT, 6) AS ct FROM props"))
def _(spark, sf_dir):
    return raw_properties(spark, sf_dir, ct="_CT")


@query("potential_temp", o.q(RAW, "SELECT cast_id, scan, round(pot_temp_C, 6) AS pot_temp_C FROM props"))
def _(spark, sf_dir):
    return rounded(seawater.with_properties(level1(spark, sf_dir)).select("cast_id", "scan", "pot_temp_C"))


@query("density", o.q(RAW, "SELECT cast_id, scan, round(density_kg_m3, 6) AS density_kg_m3 FROM props"))
def _(spark, sf_dir):
    return rounded(seawater.with_properties(level1(spark, sf_dir)).select("cast_id", "scan", "density_kg_m3"))


@query("o2_solubility", o.q(RAW, f"SELECT cast_id, scan, {o.rounded('o2_solubility_mll o2_solubility_mgl')} FROM props"))
def _(spark, sf_dir):
    rows = layers.with_oxygen(seawater.with_properties(level1(spark, sf_dir)))
    return rounded(rows.select("cast_id", "scan", "o2_solubility_mll", "o2_solubility_mgl"))


@query("o2_concentration", o.q(RAW, f"SELECT cast_id, scan, {o.rounded('o2_mgkg o2_mgl')} FROM props"))
def _(spark, sf_dir):
    return rounded(level1(spark, sf_dir).select(
        "cast_id", "scan",
        F.expr(seawater.oxygen_mgkg("temperature_C", "salinity_psu", "oxygen_saturation_percent")).alias("o2_mgkg"),
        F.expr(seawater.oxygen_mgl("temperature_C", "salinity_psu", "oxygen_saturation_percent")).alias("o2_mgl")))


@query("seabird_salinity", o.q(o.SCANS, f"""
SELECT cast_id, scan, round(CASE WHEN ctd_type = 'seabird' THEN {o.PSS} ELSE salinity_psu END, 6) AS salinity_psu,
  CASE WHEN ctd_type = 'seabird' THEN round(salinity_psu, 6) END AS salinity_psu_seabird
FROM (SELECT *, {o.PSS_ROOT} AS rr FROM scans)"""))
def _(spark, sf_dir):
    rows = layers.with_vendor_salinity(level1(spark, sf_dir))
    return rounded(rows.select("cast_id", "scan", "salinity_psu", "salinity_psu_seabird"))


@query("salinity_15c", o.q(o.SCANS, """
SELECT cast_id, scan, round(0.0080-0.1692*sqrt(r)+25.3851*r+14.0941*pow(r,1.5)-7.0261*pow(r,2)+2.7081*pow(r,2.5), 6) AS salinity_15c
FROM (SELECT *, conductivity_mS_per_m / 1000 / 4.2914 AS r FROM scans)"""))
def _(spark, sf_dir):
    return rounded(level1(spark, sf_dir).select("cast_id", "scan", F.expr(seawater.salinity_15c(
        "(conductivity_mS_per_m / 1000D)")).alias("salinity_15c")))


DERIVED = ",".join([o.SCANS, o.clean(), o.properties()])


@query("mld_temp", o.q(DERIVED + "," + o.marks(), "SELECT cast_id, round(mld_temp, 6) AS mld_temp FROM mld"))
def _(spark, sf_dir):
    return rounded(layers.mixed_layer(water(spark, sf_dir)).select("cast_id", "mld_temp"))


@query("mld_dens", o.q(DERIVED + "," + o.marks(), "SELECT cast_id, round(mld_dens, 6) AS mld_dens FROM mld"))
def _(spark, sf_dir):
    return rounded(layers.mixed_layer(water(spark, sf_dir)).select("cast_id", "mld_dens"))


@query("n2_pairs", o.q(DERIVED + "," + o.n2(), "SELECT cast_id, mid_no, round(p_mid, 6) AS p_mid, round(N2, 10) AS N2 FROM mids"))
def _(spark, sf_dir):
    return rounded(layers.n2_pairs(water(spark, sf_dir), size=size_of(spark, sf_dir)), N2=10)


@query("n2_nearest", o.q(DERIVED + "," + o.n2(), "SELECT cast_id, scan, round(N2, 10) AS N2 FROM n2"))
def _(spark, sf_dir):
    rows, size = water(spark, sf_dir), size_of(spark, sf_dir)
    return rounded(layers.n2_nearest(rows, layers.n2_pairs(rows, size=size), size=size), N2=10)


# ---- segmentation --------------------------------------------------------------------------------------------------

SPLIT = o.SCANS + "," + o.SMOOTH


def turns(spark, sf_dir):
    return fixtures.once(spark, sf_dir, "turns", lambda: segment.turning_points(
        segment.smooth_pressure(level1(spark, sf_dir), size=size_of(spark, sf_dir))))


@query("smooth_pressure", o.q(SPLIT, "SELECT cast_id, scan, round(s, 8) AS smoothed FROM sm", True))
def _(spark, sf_dir):
    return rounded(segment.smooth_pressure(level1(spark, sf_dir), size=size_of(spark, sf_dir)).select(
        "cast_id", "scan", "smoothed"), 8)


@query("pressure_minima", o.q(SPLIT, "SELECT cast_id, scan, round(s, 8) AS smoothed FROM minima", True))
def _(spark, sf_dir):
    return rounded(segment.pressure_minima(turns(spark, sf_dir), size=size_of(spark, sf_dir)), 8)


@query("thin_minima", o.q(SPLIT, "SELECT cast_id, scan FROM thin", True))
def _(spark, sf_dir):
    size = size_of(spark, sf_dir)
    return segment.thin_minima(segment.pressure_minima(turns(spark, sf_dir), size=size), size=size).select(
        "cast_id", "scan")


@query("segment_bounds", o.q(SPLIT, "SELECT cast_id, scan FROM bounds", True))
def _(spark, sf_dir):
    return segment.segment_bounds(level1(spark, sf_dir), size=size_of(spark, sf_dir))


def bounds_of(spark, sf_dir):
    return fixtures.once(spark, sf_dir, "bounds", lambda: segment.segment_bounds(
        level1(spark, sf_dir), size=size_of(spark, sf_dir)))


def parts_of(spark, sf_dir):
    size = size_of(spark, sf_dir)
    return fixtures.once(spark, sf_dir, "parts", lambda: segment.segments(
        level1(spark, sf_dir), bounds_of(spark, sf_dir), size=size))


@query("profile_names", o.q(SPLIT, 'SELECT cast_id, segment, "start", "end", profile_name FROM named', True))
def _(spark, sf_dir):
    return segment.profile_names(level1(spark, sf_dir), parts_of(spark, sf_dir))


@query("segment_profiles", o.q(SPLIT, """
SELECT named.cast_id, segment, profile_name, scan, round(pressure_dbar, 6) AS pressure_dbar
FROM named JOIN scans ON scans.cast_id = named.cast_id AND scan BETWEEN "start" AND "end" """, True))
def _(spark, sf_dir):
    rows = jobs.segment_profiles(level1(spark, sf_dir), size=size_of(spark, sf_dir))
    return rounded(rows.select("cast_id", "segment", "profile_name", "scan", "pressure_dbar"))


# ---- whole jobs ----------------------------------------------------------------------------------------------------

NUMBERS = ("pressure_dbar temperature_C conductivity_mS_per_m oxygen_saturation_percent PAR_umol_m2_s ph "
           "salinity_psu salinity_psu_seabird pot_temp_C density_kg_m3 mld_temp mld_dens o2_solubility_mll "
           "o2_solubility_mgl o2_mgkg o2_mgl depth_m")
LEVEL2_SELECT = f"SELECT {{key}}, scan, processed, is_downcast, {o.rounded(NUMBERS)}, round(PAR_avg_air, 8) AS PAR_avg_air, round(N2, 10) AS N2 FROM level2"


def level2_columns(rows, key="cast_id"):
    return rounded(rows.select(key, "scan", "processed", "is_downcast", *NUMBERS.split(), "PAR_avg_air", "N2"), N2=10)


@query("process_casts", o.q(o.SCANS + "," + o.full(), LEVEL2_SELECT.format(key="cast_id")))
def process_casts(spark, sf_dir):
    return level2_columns(jobs.process_casts(level1(spark, sf_dir), size=size_of(spark, sf_dir)))


SEGMENTED = """,
pieces AS (SELECT scans.* EXCLUDE (cast_id), named.cast_id || '_' || (segment + 1) AS profile_id
FROM named JOIN scans ON scans.cast_id = named.cast_id AND scan BETWEEN "start" AND "end"),"""


@query("process_segments", o.q(SPLIT + SEGMENTED + o.full("pieces", "profile_id"),
                               LEVEL2_SELECT.format(key="profile_id"), True))
def _(spark, sf_dir):
    return level2_columns(jobs.process_segments(level1(spark, sf_dir), size=size_of(spark, sf_dir)), "profile_id")


@query("daily_groups", o.q(o.SCANS, """
SELECT cast_id, ctd_type, strftime(coalesce(timestamp, datetime), '%Y-%m-%d') AS cast_date FROM scans WHERE scan = 0"""))
def _(spark, sf_dir):
    return reports.daily_groups(level1(spark, sf_dir)).select(
        "cast_id", "ctd_type", F.date_format("cast_date", "yyyy-MM-dd").alias("cast_date"))


@query("daily_groups_file_time", o.q(o.SCANS, """
SELECT cast_id, ctd_type, strftime(CASE WHEN cast_no % 3 = 0 THEN TIMESTAMP '2023-01-01 23:30:00' + to_days(CAST(cast_no % 500 AS INTEGER))
  ELSE coalesce(timestamp, datetime) END, '%Y-%m-%d') AS cast_date FROM scans WHERE scan = 0"""))
def _(spark, sf_dir):
    # Every third cast has no clock of its own: its day is that of its file.
    scans = level1(spark, sf_dir)
    lost = {c: F.when(F.col("cast_no") % 3 != 0, F.col(c)) for c in ("timestamp", "datetime")}
    made = F.expr("timestampadd(DAY, cast_no % 500, TIMESTAMP_NTZ'2023-01-01 23:30:00')")
    return reports.daily_groups(scans.withColumns({**lost, "modified": made}), modified="modified").select(
        "cast_id", "ctd_type", F.date_format("cast_date", "yyyy-MM-dd").alias("cast_date"))


@query("concat_daily", o.q(o.SCANS + "," + o.DAILY, """
SELECT group_id, scan, source_cast AS cast_id, source_scan, round(pressure_dbar, 6) AS pressure_dbar FROM daily"""))
def _(spark, sf_dir):
    return rounded(jobs.concat_daily(level1(spark, sf_dir)).select(
        "group_id", "scan", "cast_id", "source_scan", "pressure_dbar"))


@query("process_daily", o.q(o.SCANS + "," + o.DAILY + "," + o.full("daily", "group_id"),
                            LEVEL2_SELECT.format(key="group_id")))
def _(spark, sf_dir):
    return level2_columns(jobs.process_daily(level1(spark, sf_dir)), "group_id")


# ---- stations ------------------------------------------------------------------------------------------------------

BOOK = o.LOGBOOK + "," + o.PROFILES
MATCHED = BOOK + "," + o.MATCHES


def book(spark, sf_dir):
    return fixtures.profiles(spark, sf_dir), fixtures.logbook(spark, sf_dir)


@query("logbook_exact", o.q(BOOK, """
SELECT path, entry_no, Station FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY entry_no) AS k
FROM profiles JOIN logbook ON ctd_file = name) WHERE k = 1"""))
def _(spark, sf_dir):
    return stations.logbook_exact(*book(spark, sf_dir)).select("path", "entry_no", "Station")


def matches(spark, sf_dir):
    return stations.logbook_prefix(*book(spark, sf_dir))


@query("logbook_prefix", o.q(MATCHED, "SELECT entry_no, Station, ctd_file, path FROM matches"))
def _(spark, sf_dir):
    return matches(spark, sf_dir).select("entry_no", "Station", "ctd_file", "path")


@query("unmatched_profiles", o.q(MATCHED, "SELECT path FROM profiles WHERE path NOT IN (SELECT path FROM matches)"))
def _(spark, sf_dir):
    return stations.unmatched_profiles(fixtures.profiles(spark, sf_dir), matches(spark, sf_dir))


@query("unmatched_entries", o.q(MATCHED, """
SELECT entry_no, CASE WHEN ctd_file IS NULL THEN 'no file named' ELSE 'no profile found' END AS reason
FROM logbook WHERE entry_no NOT IN (SELECT entry_no FROM matches)"""))
def _(spark, sf_dir):
    return stations.unmatched_entries(fixtures.logbook(spark, sf_dir), matches(spark, sf_dir)).select(
        "entry_no", "reason")


@query("match_summary", o.q(MATCHED, """
SELECT (SELECT count(DISTINCT path) FROM matches) AS matched_profiles, (SELECT count(*) FROM profiles) AS total_profiles"""))
def _(spark, sf_dir):
    return stations.match_summary(fixtures.profiles(spark, sf_dir), matches(spark, sf_dir))


RELATED = """,
wanted AS (SELECT entry_no, 'subocean_file' AS kind, subocean_file AS t FROM logbook UNION ALL
           SELECT entry_no, 'exo_file', exo_file FROM logbook UNION ALL SELECT entry_no, 'exo_file_2', exo_file_2 FROM logbook),
hits AS (SELECT entry_no, kind, path, row_number() OVER (PARTITION BY entry_no, kind ORDER BY translate(directory, '/', chr(1)),
           CASE WHEN base_name = t THEN 0 WHEN lower(base_name) = lower(t) THEN 1 ELSE 2 END, base_name, path) AS k
         FROM wanted, parts WHERE lower(base_name) = lower(t) OR contains(base_name, t)),
related AS (
  SELECT entry_no, 'subocean_log' AS kind, replace(path, '.txt', '.log') AS path FROM hits WHERE k = 1 AND kind = 'subocean_file' UNION ALL
  SELECT entry_no, 'subocean', replace(path, '.log', '.txt') FROM hits WHERE k = 1 AND kind = 'subocean_file' UNION ALL
  SELECT entry_no, kind, path FROM hits WHERE k = 1 AND kind <> 'subocean_file')"""


@query("related_files", o.q(o.LOGBOOK + "," + o.FILES + RELATED, "SELECT entry_no, kind, path FROM related"))
def _(spark, sf_dir):
    return stations.related_files(fixtures.logbook(spark, sf_dir), fixtures.raw_files(spark, sf_dir))


# ---- level tables --------------------------------------------------------------------------------------------------

TABLE = "pressure_dbar temperature_C density_kg_m3 mld_dens o2_mgl"
COMBINED = o.SCANS + "," + o.full() + "," + o.LOGBOOK + "," + o.STATIONED


def written(spark, sf_dir, label, write):
    """Write a table under the shared folder once, return its path."""
    key = (spark.sparkContext.applicationId, sf_dir, f"path-{label}")
    if key not in fixtures._TABLES:
        fixtures._TABLES[key] = write(stage_path(spark, label))
    return fixtures._TABLES[key]


def sink(spark, sf_dir, write, path):
    rows, placed = combined_for_sink(spark, sf_dir)
    return write(rows, path, placed=placed)


@query("level2_table", o.q(COMBINED, f"SELECT campaign, profile_name AS cast_id, scan, {o.rounded(TABLE)} FROM combined"))
def _(spark, sf_dir):
    path = written(spark, sf_dir, "level2_table", lambda p: sink(spark, sf_dir, tables.write_profiles, p))
    return rounded(spark.read.parquet(path).select("campaign", "cast_id", "scan", *TABLE.split()))


PLACED = """,
placed AS (SELECT DISTINCT regexp_extract(path, 'cast_[0-9]+') AS cast_id, coalesce(campaign, 'none') AS campaign, Station FROM matches)"""


@query("level2b_table", o.q(o.SCANS + "," + o.full() + "," + MATCHED + PLACED, f"""
SELECT campaign, Station, cast_id, scan, {o.rounded(TABLE)} FROM level2 JOIN placed USING (cast_id)"""))
def _(spark, sf_dir):
    def write(path):
        rows = processed(spark, sf_dir).withColumn("path", F.concat(F.lit("level2/"), "cast_id", F.lit("_1.csv")))
        entries = fixtures.logbook(spark, sf_dir).withColumn("campaign", F.coalesce("campaign", F.lit("none")))
        done = jobs.organise_stations(fixtures.profiles(spark, sf_dir), rows, entries)
        return tables.write_stations(done["rows"], path)
    path = written(spark, sf_dir, "level2b_table", write)
    return rounded(spark.read.parquet(path).select("campaign", "Station", "cast_id", "scan", *TABLE.split()))


STATION_FILES = """,
sited AS (SELECT replace(path, 'level2/', 'level2/' || f || '/') AS path, name FROM profiles, (VALUES ('a'), ('b')) v(f)),
firsts AS (SELECT entry_no, min(path) AS path FROM logbook, sited
  WHERE ctd_file = name OR (regexp_replace(name, '_?[^_]*$', '') <> '' AND starts_with(ctd_file, regexp_replace(name, '_?[^_]*$', '')))
  GROUP BY entry_no),
placings AS (SELECT entry_no, coalesce(campaign, '') AS campaign, Station, path FROM logbook JOIN firsts USING (entry_no)),
copies AS (SELECT entry_no, campaign, Station, 'profile' AS kind, path FROM placings UNION ALL
  SELECT entry_no, campaign, Station, kind, related.path FROM related JOIN placings USING (entry_no))"""


def sited_profiles(spark, sf_dir):
    """Profiles of one name in two folders."""
    return fixtures.profiles(spark, sf_dir).select(F.explode(F.array(*[
        F.replace("path", F.lit("level2/"), F.lit(f"level2/{folder}/")) for folder in "ba"])).alias("path"))


def organised(spark, sf_dir):
    rows = processed(spark, sf_dir).select("cast_id", "scan", "pressure_dbar").select("*", F.explode(F.array(*[F.concat(
        F.lit(f"level2/{folder}/"), "cast_id", F.lit("_1.csv")) for folder in "ab"])).alias("path"))
    return jobs.organise_stations(sited_profiles(spark, sf_dir), rows, fixtures.logbook(spark, sf_dir), fixtures.raw_files(spark, sf_dir))


@query("station_files", o.q(BOOK + "," + o.FILES + RELATED + STATION_FILES, """
SELECT campaign, Station, regexp_extract(path, '[^/]*$') AS file_name, kind, path AS source, entry_no FROM (
  SELECT *, row_number() OVER (PARTITION BY campaign, Station, regexp_extract(path, '[^/]*$')
    ORDER BY entry_no DESC, kind <> 'profile' DESC, kind DESC, path DESC) AS k FROM copies) WHERE k = 1"""))
def _(spark, sf_dir):
    return organised(spark, sf_dir)["files"]


@query("station_rows", o.q(o.SCANS + "," + o.full() + "," + BOOK + "," + o.FILES + RELATED + STATION_FILES, f"""
SELECT campaign, Station, path, cast_id, scan, {o.rounded("pressure_dbar")}
FROM (SELECT DISTINCT campaign, Station, path FROM placings) JOIN level2 ON path = 'level2/a/' || cast_id || '_1.csv'"""))
def _(spark, sf_dir):
    return rounded(organised(spark, sf_dir)["rows"].select("campaign", "Station", "path", "cast_id", "scan", "pressure_dbar"))


@query("combined_scan", o.q(COMBINED, f"""
SELECT profile_name, scan, {o.rounded(TABLE)}, CASE WHEN ctd_type = 'seabird' THEN round(salinity_psu_seabird, 6) END AS salinity_psu_seabird,
  is_downcast FROM combined"""))
def _(spark, sf_dir):
    base = ["profile_name", "scan", *TABLE.split(), "is_downcast"]
    rows = combined(spark, sf_dir)

    def write(path):
        # Two kinds of files with different columns, and one that is only metadata.
        plain = rows.where("ctd_type <> 'seabird'").select(*base)
        vendor = rows.where("ctd_type = 'seabird'").select("salinity_psu_seabird", *base)
        tables.write_csv_profiles(plain, f"{path}/a")
        tables.write_csv_profiles(vendor, f"{path}/b")
        tables.write_csv_profiles(plain.where("scan = 30").withColumn("profile_name", F.lit("cast_metadata")), f"{path}/c")
        return path

    columns = {"scan": "bigint", **{c: "double" for c in TABLE.split()}, "salinity_psu_seabird": "double",
               "is_downcast": "boolean"}
    return rounded(tables.read_profiles(spark, written(spark, sf_dir, "combined_csv", write), columns))


@query("combined_table", o.q(COMBINED, f"SELECT campaign, Station, profile_name, scan, {o.rounded(TABLE)} FROM combined"))
def _(spark, sf_dir):
    path = written(spark, sf_dir, "combined_table", lambda p: sink(spark, sf_dir, tables.write_combined, p))
    return rounded(spark.read.parquet(path).select("campaign", "Station", "profile_name", "scan", *TABLE.split()))


# ---- export --------------------------------------------------------------------------------------------------------

PSI = ("SELECT cast_id, scan, temperature_C AS Tv2C, salinity_psu AS Sal2, oxygen_saturation_percent AS Sbeox2PS, "
       "pressure_dbar * 1.45038 AS PrdE, datetime, timestamp FROM level2")
LAYOUT = o.rounded("Tv2C Sal2 Sbeox2PS") + ", round(PrdE, 10) AS PrdE"


SPLIT_LAYOUT = o.SCANS + "," + o.full() + f""", a AS ({PSI}),
b AS (SELECT *, max("PrdE") OVER (PARTITION BY cast_id) AS mx FROM a),
c AS (SELECT *, min(CASE WHEN "PrdE" = mx THEN scan END) OVER (PARTITION BY cast_id) AS turn FROM b),
d AS (SELECT *, CASE WHEN scan < turn THEN 'downward' ELSE 'upward' END AS direction,
      count(*) FILTER (WHERE scan >= turn) OVER (PARTITION BY cast_id) AS n_up FROM c)"""


@query("a2ps_split", o.q(SPLIT_LAYOUT, f"""
SELECT cast_id, direction, {LAYOUT} FROM (
  SELECT *, row_number() OVER (PARTITION BY cast_id, direction, "PrdE" ORDER BY scan) AS k FROM d
  WHERE direction = 'downward' OR n_up > 1) WHERE k = 1"""))
def _(spark, sf_dir):
    return rounded(export.a2ps_split(processed(spark, sf_dir)))


@query("a2ps_whole", o.q(o.SCANS + "," + o.full() + f", a AS ({PSI})", f"""
SELECT cast_id, {LAYOUT} FROM (
  SELECT *, row_number() OVER (PARTITION BY cast_id, "PrdE" ORDER BY scan) AS k FROM a) WHERE k = 1"""))
def _(spark, sf_dir):
    return rounded(export.a2ps_whole(processed(spark, sf_dir)))


@query("a2ps_clock", o.q(o.SCANS + "," + o.full() + f", a AS ({PSI})", f"""
SELECT cast_id, scan, {LAYOUT}, strftime(coalesce(timestamp, datetime), '%H:%M:%S') AS "hh:mm:ss",
  strftime(coalesce(timestamp, datetime), '%m/%d/%Y') AS "mm/dd/yyyy" FROM a"""))
def _(spark, sf_dir):
    rows = processed(spark, sf_dir).withColumn("clock", F.coalesce("timestamp", "datetime"))
    return rounded(export.a2ps_clock(rows, clock="clock"))


def exported(spark, sf_dir, form):
    """Layout files written to the shared folder and read back, with the row's number in its file."""
    def build():
        rows = processed(spark, sf_dir).withColumn("clock", F.coalesce("timestamp", "datetime"))
        return jobs.export_a2ps(rows, stage_path(spark, f"a2ps-{form}"), form, clock="clock")["files"]
    return fixtures.once(spark, sf_dir, f"a2ps-{form}", build)


def layout_cells(rows):
    return [F.col("cells")[c].try_cast("double").alias(c) for c in ("PrdE", "Tv2C", "Sal2", "Sbeox2PS")]


@query("export_a2ps", o.q(SPLIT_LAYOUT, f"""
SELECT cast_id || '_' || direction || '_formatted' AS file, row_number() OVER (PARTITION BY cast_id, direction ORDER BY "PrdE") - 1 AS row_no, {LAYOUT}
FROM (SELECT *, row_number() OVER (PARTITION BY cast_id, direction, "PrdE" ORDER BY scan) AS k FROM d
  WHERE direction = 'downward' OR n_up > 1) WHERE k = 1"""))
def _(spark, sf_dir):
    rows = exported(spark, sf_dir, "split")
    return rounded(rows.select("file", "row_no", *layout_cells(rows)))


@query("export_a2ps_clock", o.q(o.SCANS + "," + o.full() + f", a AS ({PSI})", f"""
SELECT cast_id || '_formatted' AS file, row_number() OVER (PARTITION BY cast_id ORDER BY scan) - 1 AS row_no, {LAYOUT},
  strftime(coalesce(timestamp, datetime), '%H:%M:%S') AS "hh:mm:ss" FROM a"""))
def _(spark, sf_dir):
    rows = exported(spark, sf_dir, "clock")
    return rounded(rows.select("file", "row_no", *layout_cells(rows), F.col("cells")["hh:mm:ss"].alias("hh:mm:ss")))


# ---- summaries -----------------------------------------------------------------------------------------------------

@query("sheet_discrete", o.q(COMBINED, """
SELECT profile_name, round(station_ODV, 6) AS station_ODV, round(avg(mld_dens), 6) AS avg_mld_dens, round(avg(mld_temp), 6) AS avg_mld_temp,
  round(avg(PAR_avg_air), 8) AS avg_PAR_avg_air FROM combined WHERE station_ODV BETWEEN 1 AND 33 GROUP BY ALL"""))
def _(spark, sf_dir):
    return rounded(reports.sheet_discrete(combined(spark, sf_dir)), avg_PAR_avg_air=8)


DRAFT = ("round(avg(temperature_C), 8) AS avg_temperature_C, round(avg(density_kg_m3), 6) AS avg_density_kg_m3, "
         "round(sum(mld_dens), 6) AS sum_mld_dens")


@query("sheet_draft", o.q(COMBINED, f"""
SELECT depth_m, Station, strftime(date, '%Y-%m-%d') AS date, {DRAFT} FROM combined WHERE Station = 'ST1' GROUP BY depth_m, Station, combined.date"""))
def _(spark, sf_dir):
    rows = combined(spark, sf_dir)
    return rounded(reports.sheet_draft(rows, "ST1").withColumn("date", F.date_format("date", "yyyy-MM-dd")),
                   8, sum_mld_dens=6, avg_density_kg_m3=6)


@query("sheet_draft_pressure", o.q(COMBINED, f"""
SELECT pressure_dbar, strftime(date, '%Y-%m-%d') AS date, {DRAFT} FROM combined WHERE profile_name IS NOT NULL GROUP BY pressure_dbar, combined.date"""))
def _(spark, sf_dir):
    return rounded(reports.sheet_draft_pressure(combined(spark, sf_dir)).withColumn(
        "date", F.date_format("date", "yyyy-MM-dd")), 8, sum_mld_dens=6, avg_density_kg_m3=6)


@query("non_null_profiles", o.q(o.PROFILES + "," + o.LOGBOOK, """
SELECT path, entry_no FROM profiles LEFT JOIN logbook ON ctd_file = name WHERE entry_no IS NOT NULL"""))
def _(spark, sf_dir):
    entries = fixtures.logbook(spark, sf_dir).select("entry_no", F.col("ctd_file").alias("profile_name"))
    paths = fixtures.profiles(spark, sf_dir).select("path", text.base_name(F.col("path")).alias("_name"))
    rows = paths.join(entries, F.col("_name") == F.col("profile_name"), "left")
    return reports.named_profiles(rows).select("path", "entry_no")


@query("sheet_map", o.q(COMBINED, """
SELECT round(Latitude, 6) AS Latitude, round(Longitude, 6) AS Longitude, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, Station,
  station_ODV, round(max(depth_m), 6) AS max_depth_m FROM combined GROUP BY combined.Latitude, combined.Longitude, combined.datetime, Station, station_ODV"""))
def _(spark, sf_dir):
    return rounded(reports.sheet_map(combined(spark, sf_dir)).withColumn("datetime", stamp("datetime")))


@query("sheet_measurement", o.q(COMBINED, """
SELECT depth_m, Station, measure, round(value, 8) AS value FROM (
  SELECT depth_m, Station, 'temperature_C' AS measure, avg(temperature_C) AS value FROM combined GROUP BY depth_m, Station UNION ALL
  SELECT depth_m, Station, 'oxygen_saturation_percent', avg(oxygen_saturation_percent) FROM combined GROUP BY depth_m, Station)"""))
def _(spark, sf_dir):
    return rounded(reports.sheet_measurement(
        combined(spark, sf_dir), ["temperature_C", "oxygen_saturation_percent"]), 8)


@query("sheet_station", o.q(COMBINED, """
SELECT depth_m, measure, round(value, 7) AS value, round(CASE WHEN value > 0 THEN log10(value) END, 8) AS log_value FROM (
  SELECT depth_m, 'pot_temp_C' AS measure, avg(pot_temp_C) AS value FROM combined WHERE Station = 'ST2' GROUP BY depth_m UNION ALL
  SELECT depth_m, 'temperature_C', avg(temperature_C) FROM combined WHERE Station = 'ST2' GROUP BY depth_m UNION ALL
  SELECT depth_m, 'oxygen_concentration_ml_per_L', avg(o2_mgl) FROM combined WHERE Station = 'ST2' GROUP BY depth_m)"""))
def sheet_station(spark, sf_dir):
    rows = combined(spark, sf_dir).withColumn("oxygen_concentration_ml_per_L", F.col("o2_mgl"))
    return rounded(reports.sheet_station(rows, "ST2", log_scale=True), 8, value=7)


PRESENT = [c for c in schema.MEASURES if c in (NUMBERS + " PAR_avg_air N2").split()]


@query("measure_totals", o.q(COMBINED, "SELECT Station, count(*) AS n_rows, " + ", ".join(
    f"round(avg({c}), {10 if c == 'N2' else 7}) AS avg_{c}, round(sum({c}), {8 if c == 'N2' else 5}) AS sum_{c}"
    for c in PRESENT) + " FROM combined GROUP BY Station"))
def _(spark, sf_dir):
    totals = reports.measure_totals(combined(spark, sf_dir), measures=PRESENT)
    return rounded(totals, 7, avg_N2=10, sum_N2=8, **{f"sum_{c}": 5 for c in PRESENT if c != "N2"})


LONG = "temperature_C salinity_psu density_kg_m3 o2_mgl"


@query("profile_long", o.q(o.SCANS + "," + o.full(), " UNION ALL ".join(
    f"SELECT cast_id, scan, round(depth_m, 6) AS depth_m, '{c}' AS measure, round({c}, 6) AS value FROM level2"
    for c in LONG.split())))
def _(spark, sf_dir):
    return rounded(reports.profile_long(processed(spark, sf_dir).select("cast_id", "scan", "depth_m", *LONG.split())))
