"""A tree of instrument files written from the standard scans, so that file jobs run on real files.

Two campaigns, each with a folder per instrument, its own activity log and unit lists. Folder and file names have blanks and
letters beyond ASCII, extensions come in both cases, Exo files are UTF-16 of either byte order, some Idronaut files have a
blank line, and a few files hold nothing a reader takes.
"""

from pyspark.sql import functions as F

from fathomline import fixtures
from fathomline.storage import save_named_files, stage_path

LITTLE, BIG = "UTF-16LE", "UTF-16BE"


def _number(column):
    return F.regexp_extract(column, r"cast_(\d+)", 1).cast("bigint")


def campaign(k):
    return F.when(k % 2 == 0, "north field").otherwise("süd 2")


def _named(lines, folder, before, after):
    """Lines with the path of their file in the tree."""
    k = _number("path")
    return lines.select(F.concat(campaign(k), F.lit(f"/{folder}/{before}cast_"), k.cast("string"), F.lit(after)).alias("file"),
                        k.alias("k"), "line_no", "line")


def _plain(lines):
    return lines.select("file", "line_no", F.col("line").alias("value"))


def _wide(lines):
    """UTF-16 bytes of each line but the one 0x0A that the writer adds: little endian has its other half at the next line's
    start, big endian at the line's end."""
    zero, first = F.expr("X'00'"), F.col("line_no") == 0
    little = F.concat(F.when(first, F.expr("X'FFFE'")).otherwise(zero), F.encode("line", LITTLE))
    big = F.concat(F.when(first, F.expr("X'FEFF'")).otherwise(F.expr("X''")), F.encode("line", BIG), zero)
    return lines.select("file", "line_no", F.when(F.col("k") % 4 < 2, little).otherwise(big).cast("string").alias("value"))


def _logs(activity):
    """The log of each campaign: the same stations, in the second one degree further west."""
    def row(where, degree):
        return F.struct(F.lit(where).alias("file"), F.concat_ws(
            ",", "Activity", "station_ID", F.col("station_ODV").cast("string"), "date",
            *[F.concat(F.lit('"'), F.coalesce(c, F.lit("")), F.lit('"')) for c in (
                F.col("lat IN"), F.col("lat OUT"), F.replace("long IN", F.lit("45°"), F.lit(f"{degree}°")))], "time In").alias("value"))
    head = activity.sparkSession.createDataFrame([("head",)], "x string").select(F.explode(F.array(*[F.struct(
        F.lit(where).alias("file"), F.lit(-1).cast("bigint").alias("line_no"),
        F.lit("Activity,station_ID,station_ODV,date,lat IN,lat OUT,long IN,time In").alias("value")) for where in LOGS])).alias("r")).select("r.*")
    rows = activity.select(F.hash("station_ID", "Activity").cast("bigint").alias("n"), F.explode(F.array(
        row(LOGS[0], 45), row(LOGS[1], 46))).alias("r"))
    return head.unionByName(rows.select("r.file", (F.col("n") + 2**31).alias("line_no"), "r.value"))


LOGS = ("north field/activity_log_ODV.csv", "süd 2/Activity_Log_ODV.CSV")


def _unit_lists(suppliers):
    """By cast: a text list, a JSON list, or none; beside each list another JSON of lower rank."""
    k = F.col("s_suppkey")
    rbr = suppliers.where((k % 5 == 2) & (k % 3 != 2))
    base = F.concat(campaign(k), F.lit("/RBR/cast_"), k.cast("string"))
    unit = F.when(k % 4 == 0, "mS/cm").otherwise("mS/m")

    def listed(name, unit):
        text = F.concat(F.lit('{"dataheader":[{"name":"Conductivity",\n"units":"'), unit, F.lit('"},{"name":"Depth"}]}'))
        return F.struct(F.concat(base, name).alias("file"), F.lit(0).cast("bigint").alias("line_no"), text.alias("value"))

    return rbr.select(F.explode(F.array(
        listed(F.when(k % 3 == 0, "_metadata.txt").otherwise("_metadata.json"), unit), listed(F.lit(".json"), F.lit("decoy")))).alias("r")).select("r.*")


def write_raw_tree(spark, sf_dir, idronaut, seabird, rbr, exo, gf23, activity):
    """Write the files; the arguments are the lines of each instrument and the rows of the log. Returns the folder."""
    broken = idronaut.withColumn("line", F.when((_number("path") % 3 == 0) & (F.col("line_no") == 9), F.concat(
        "line", F.lit("\n"))).otherwise(F.col("line")))
    odd = spark.createDataFrame([("north field/suboceanexperiment_1.txt", 0, "x"), ("süd 2/exo/KOR empty.csv", 0, "only a preamble"),
                                 ("süd 2/notes.csv", 0, "a,b")], "file string, line_no bigint, value string")
    parts = [_plain(_named(broken, "idro", "", "_Idronaut.txt")), _plain(_named(seabird, "sb", "", ".CNV")),
             _plain(_named(rbr, "RBR", "", "_data.txt")), _wide(_named(exo, "exo", "KOR ", ".CSV")),
             _plain(_named(gf23, "gf", "", ".TXT")), _logs(activity), _unit_lists(fixtures.table(spark, sf_dir, "supplier")), odd]
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    root = stage_path(spark, "raw-files")
    save_named_files(rows, root)
    return root
