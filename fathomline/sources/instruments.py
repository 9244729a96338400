"""Instrument text -> standard scans, as one job per format over a table of lines ``(path, line_no, line)``.

A file's header is a few lines, so it becomes one row per path (positions of the columns, first data line) joined back to
the data lines; the planner broadcasts it by size, or shuffles both sides with skew splitting. Names are looked up there,
once per file. Data lines are never collected: each is split and read by the positions its header gives.

Lines come with ``line_no`` (all lines of the file), ``row_no`` (those that are not blank) and ``modified`` (the file's
time); where the last two are missing, no line is blank and the time is unknown.
"""

from pyspark.sql import functions as F

from fathomline import schema
from fathomline.functions.text import clock, day_first_date, gps_to_degrees, instant, stem, underscored
from fathomline.sources.files import csv_cells

TEXT_COLUMNS = {"date", "time", "timestamp", "scan", "flag"}
# Columns that are known by another name than the instrument's own table has.
ALSO_KNOWN = {"idronaut": {"ph": ["pH"]}}


def position_of(wanted, names="names", lowered="lowered"):
    """1-based position of the first of ``wanted`` in the header, exact spelling first, then any case; 0 if absent."""
    ways = [(names, w) for w in wanted] + [(lowered, w.lower()) for w in wanted]
    found = [F.nullif(F.array_position(column, w), F.lit(0)) for column, w in ways]
    return F.coalesce(*found, F.lit(0).cast("bigint"))


def standard_names(ctd_type):
    return {**schema.standard_names(ctd_type), **ALSO_KNOWN.get(ctd_type, {})}


def worked_out(df, **columns):
    """Columns computed once per row: the row passes through a generator, which later projections are not merged into, so
    an expression that is used many times is not repeated at every use."""
    held = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_held")
    return df.select(*[c for c in df.columns if c not in columns], held).select(
        *[c for c in df.columns if c not in columns], "_held.*")


def with_positions(headers, ctd_type, shown=None):
    """Header rows ``(path, names, ...)`` plus ``at``, a struct with the position of every standard column, and the names
    (``shown`` if given) and positions of the columns the mapping does not know; of a repeated name the first column."""
    known = F.array(*[F.lit(raw.lower()) for raw, _, _ in schema.COLUMN_NAMES[ctd_type]])
    names = F.col("names")
    headers = worked_out(headers, names=names, shown=shown if shown is not None else names, lowered=F.transform(names, lambda n: F.lower(n)))
    named = F.transform("shown", lambda n, i: F.struct(n.alias("n"), i.alias("i")))
    left = F.filter(named, lambda e: e["n"].isNotNull() & ~F.array_contains(known, F.get("lowered", e["i"])))
    first = F.filter(left, lambda e, k: ~F.exists(F.slice(left, 1, k), lambda o: o["n"] == e["n"]))
    headers = worked_out(
        headers, more=first, at=F.struct(*[position_of(raws).alias(standard) for standard, raws in standard_names(ctd_type).items()]))
    return headers.withColumns({"more_names": F.transform("more", lambda e: e["n"]),
                                "more_at": F.transform("more", lambda e: e["i"])}).drop("more", "shown", "lowered")


def numbered(lines):
    """Lines with the columns every reader expects."""
    lines = lines if "row_no" in lines.columns else lines.withColumn("row_no", F.col("line_no"))
    return lines if "modified" in lines.columns else lines.withColumn("modified", F.lit(None).cast("timestamp"))


def standardize(lines, ctd_type, keep=()):
    """Data lines with ``at``, ``more_names``, ``more_at`` and ``cells`` -> standard columns in standard units, and the rest
    as ``extras``, a MAP name -> text.

    Text that is not a number becomes missing, as does NaN.
    """
    columns = []
    for standard in standard_names(ctd_type):
        cell = F.trim(F.get("cells", (F.col("at")[standard] - 1).cast("int")))
        if standard in TEXT_COLUMNS:
            columns.append(cell.alias(f"{standard}_text"))
            continue
        value = cell.try_cast("double")
        value = F.when(~F.isnan(value), value)
        factor = schema.factor_of(standard, ctd_type)
        columns.append((value if factor == 1.0 else value * factor).alias(standard))
    # A line may be shorter than its header.
    extras = F.map_from_arrays("more_names", F.transform("more_at", lambda i: F.get("cells", i)))
    return lines.select("path", "scan", "modified", F.lit(ctd_type).alias("ctd_type"), *columns, extras.alias("extras"), *keep)


def _data(lines, headers, split):
    """Data lines of each file, split into cells; ``scan`` counts them from 0, blank lines left out."""
    joined = lines.join(headers, "path").where((F.col("line_no") >= F.col("first_line")) & (F.trim("line") != ""))
    return joined.withColumns({"cells": split, "scan": F.col("row_no") - F.col("first_row")})


def _commas(column):
    """Cells of a comma table; the slower way only for lines that have quotes."""
    return F.when(F.contains(column, F.lit('"')), csv_cells(column)).otherwise(F.split(column, ","))


def _words(column):
    return F.split(F.trim(column), r"\s+")


def ingest_idronaut(lines):
    """Blank-separated table; a second line with units is dropped and kept as ``units``; date and time become one."""
    lines = numbered(lines)
    top = lines.where("line_no < 2").groupBy("path").agg(
        F.max(F.when(F.col("line_no") == 0, F.col("line"))).alias("_head"), F.min("row_no").alias("_row"),
        F.max(F.when(F.col("line_no") == 1, F.col("line"))).alias("_second"))
    second = F.coalesce("_second", F.lit(""))
    has_units = second.contains("[") | second.contains("dbar") | second.contains("°C") | second.contains("PSU")
    names = _words(F.col("_head"))
    # Without a column called Date the first one with Date in its name takes that role.
    dated = F.get(F.filter(names, lambda n: n.contains("Date")), F.lit(0))
    names = F.when(F.array_contains(names, "Date"), names).otherwise(
        F.transform(names, lambda n: F.when(n == dated, "Date").otherwise(n)))
    pairs = F.filter(F.arrays_zip(_words(F.col("_head")).alias("name"), _words(second).alias("unit")),
                     lambda e: e["unit"].contains("[") & e["unit"].contains("]"))
    units = F.map_from_entries(F.transform(pairs, lambda e: F.struct(
        e["name"], F.regexp_replace(e["unit"], r"^[\[\]]+|[\[\]]+$", ""))))
    headers = top.select(
        "path", names.alias("names"), F.when(has_units, 2).otherwise(1).alias("first_line"),
        (F.col("_row") + F.when(has_units, 2).otherwise(1)).alias("first_row"), F.when(has_units, units).alias("units"))
    rows = _data(lines, with_positions(headers, "idronaut"), _words(F.col("line")))
    return standardize(rows, "idronaut", ["units"]).withColumn("datetime", clock(F.col("date_text"), F.col("time_text")))


def ingest_seabird(lines):
    """Column names from the numbered name lines, data after the end mark."""
    lines = numbered(lines)
    name = r"^# name\s+(\d+)\s*=\s*([^:]*)"
    found = F.regexp_extract("line", name, 1)
    marks = lines.where(F.col("line").startswith("# name") | F.col("line").contains("*END*"))
    headers = marks.groupBy("path").agg(
        F.array_sort(F.collect_list(F.when(found != "", F.struct(
            found.cast("int").alias("i"), F.trim(F.regexp_extract("line", name, 2)).alias("n"))))).alias("_names"),
        F.min(F.when(F.col("line").contains("*END*"), F.struct("line_no", "row_no"))).alias("_end"))
    headers = headers.select(
        "path", F.transform("_names", lambda e: e["n"]).alias("names"),
        F.coalesce(F.col("_end.line_no") + 1, F.lit(0)).alias("first_line"),
        F.coalesce(F.col("_end.row_no") + 1, F.lit(0)).alias("first_row"))
    rows = _data(lines, with_positions(headers, "seabird"), _words(F.col("line")))
    return standardize(rows, "seabird").withColumn("flag", F.col("flag_text").try_cast("double")).drop("flag_text")


def ingest_gf23(lines, log=None, folders=None):
    """Eleven fixed columns after two lines; ``**`` marks removed; the file name is the station.

    With ``log`` (``activity_log``) position, date and clock of the station come along. ``folders`` (``path, folder``) names
    the folder whose log a file belongs to, where there are several; the log then has that column too.
    """
    lines = numbered(lines)
    # The columns are the same in every file; only the rows that the two lines take up are looked up.
    headers = lines.where("line_no < 2").groupBy("path").agg(F.count_if(F.trim("line") != "").alias("first_row")).withColumn(
        "first_line", F.lit(2))
    clean = F.regexp_replace("line", r"\*\*", "")
    place = {name: i for i, name in enumerate(schema.GF23_COLUMNS, 1)}
    fixed = {"at": F.struct(*[F.lit(next((place[r] for r in raws if r in place), 0)).alias(standard)
                              for standard, raws in standard_names("gf23").items()]),
             "more_names": F.array().cast("array<string>"), "more_at": F.array().cast("array<int>")}
    rows = standardize(_data(lines, headers, _words(clean)).withColumns(fixed), "gf23")
    rows = rows.drop("date_text", "time_text").withColumn("Station", stem(F.col("path")))
    if log is None:
        return rows
    if folders is None:
        return rows.join(log, "Station", "left")
    return rows.join(folders, "path", "left").join(log, ["folder", "Station"], "left").drop("folder")


def ingest_exo(lines):
    """Comma table under nine lines of preamble (in files, UTF-16 text); the header is the first line with text after them."""
    lines = numbered(lines)
    headers = lines.where((F.col("line_no") >= 9) & (F.trim("line") != "")).groupBy("path").agg(
        F.min(F.struct("line_no", "row_no", "line")).alias("_head")).select(
        "path", F.transform(_commas(F.col("_head.line")), lambda n: F.trim(n)).alias("names"),
        (F.col("_head.line_no") + 1).alias("first_line"), (F.col("_head.row_no") + 1).alias("first_row"))
    rows = _data(lines, with_positions(headers, "exo"), _commas(F.col("line")))
    return standardize(rows, "exo").withColumn("datetime", clock(F.col("date_text"), F.col("time_text")))


def ingest_rbr(lines, units=None, convert=False):
    """Comma table with a header; a repeated column name counts up (``name.1``); blanks in left-over names become ``_``.

    ``units`` is the table of ``unit_table``. With ``convert`` conductivity in mS/cm and oxygen in umol/L are brought to
    the standard units; off by default, so results equal those of files without a unit list.
    """
    lines = numbered(lines)
    raw = F.transform(_commas(F.col("line")), lambda n: F.trim(n))
    seen = F.transform(raw, lambda n, i: F.size(F.filter(F.slice(raw, 1, i), lambda o: o == n)))
    names = F.transform(F.arrays_zip(raw.alias("n"), seen.alias("k")), lambda e: F.when(
        e["k"] == 0, e["n"]).otherwise(F.concat(e["n"], F.lit("."), e["k"].cast("string"))))
    headers = lines.where((F.col("row_no") == 0) & (F.trim("line") != "")).select(
        "path", names.alias("names"), (F.col("line_no") + 1).alias("first_line"), F.lit(1).alias("first_row"))
    rows = _data(lines, with_positions(headers, "rbr", underscored(F.col("names"))), _commas(F.col("line")))
    rows = standardize(rows, "rbr")
    # A file with separate Date and Time columns: together they are the timestamp.
    day = F.coalesce(F.get(F.map_values(F.map_filter("extras", lambda k, v: F.lower(k).contains("date"))), F.lit(0)),
                     F.lit(None).cast("string"))
    rows = rows.withColumn("timestamp", F.when(day.isNotNull(), clock(day, F.col("timestamp_text")))
                           .otherwise(instant(F.col("timestamp_text")))).drop("timestamp_text")
    if units is None:
        return rows
    rows = rows.join(units, "path", "left")
    return convert_by_units(rows) if convert else rows


def convert_by_units(rows):
    """mS/cm -> mS/m and umol/L -> ml/L where the unit list says so."""
    cond, oxygen = F.col("units")["Conductivity"], F.col("units")["Dissolved O2 concentration"]
    micro = oxygen.isin("umol/L", "µmol/L", "μmol/L")
    return rows.withColumns({
        "conductivity_mS_per_m": F.when(cond == "mS/cm", F.col("conductivity_mS_per_m") * 100.0)
        .otherwise(F.col("conductivity_mS_per_m")),
        "oxygen_concentration_ml_per_L": F.when(micro, F.col("oxygen_concentration_ml_per_L") / 44.661)
        .otherwise(F.col("oxygen_concentration_ml_per_L")),
    })


def activity_log(raw):
    """CTD rows of an activity log: station, number, date, position in degrees, clock; ``folder`` too if the rows have it."""
    ctd = raw.where(F.col("Activity") == "CTD")
    latitude = F.coalesce(F.nullif(F.trim("lat IN"), F.lit("")), F.col("lat OUT"))
    day = day_first_date(F.trim("date"))
    return ctd.select(
        *(["folder"] if "folder" in raw.columns else []), F.col("station_ID").alias("Station"), F.col("station_ODV").try_cast("double").alias("station_ODV"),
        day.alias("date"), gps_to_degrees(latitude).alias("Latitude"),
        (gps_to_degrees(F.col("long IN")) * -1).alias("Longitude"), F.trim("time In").alias("time"),
        instant(F.concat_ws(" ", F.date_format(day, "yyyy-MM-dd"), F.trim("time In"))).alias("datetime"))
