"""Paths, positions, dates and unit lists as column expressions."""

from pyspark.sql import functions as F


def base_name(path):
    return F.element_at(F.split(F.regexp_replace(path, r"\\", "/"), "/"), -1)


def directory(path):
    """Everything before the last slash; empty for a bare name."""
    return F.regexp_replace(F.regexp_replace(path, r"\\", "/"), r"/?[^/]*$", "")


def extension(path):
    """Lower-cased extension with its dot; empty when there is none."""
    return F.lower(F.regexp_extract(base_name(path), r"[^.](\.[^.]*)$", 1))


def stem(path):
    """Base name without its extension."""
    return F.regexp_replace(base_name(path), r"(?<=[^.])\.[^.]*$", "")


def walk_order(directory_column):
    """Sort key that lists a folder right before its subfolders."""
    return F.translate(directory_column, "/", "\u0001")


def gps_to_degrees(text):
    """``60°12,345'`` -> 60.20575; not parsable -> NULL."""
    parts = F.split(F.translate(F.regexp_replace(text, "[’'‘]", ""), ",", "."), "°")
    whole, minutes = (F.trim(F.get(parts, F.lit(i))).try_cast("double") for i in (0, 1))
    return whole + minutes / 60.0


def day_first_date(text):
    """``dd.MM.yy`` or ``dd.MM.yyyy``."""
    short = F.when(F.length(F.element_at(F.split(text, r"\."), -1)) == 2, text)
    return F.coalesce(F.try_to_date(short, "d.M.yy"), F.try_to_date(text, "d.M.yyyy"))


# Date layouts tried in turn, month before day where both could be meant.
DATE_LAYOUTS = ["yyyy-M-d", "yyyy/M/d", "M-d-yyyy", "M/d/yyyy", "M.d.yyyy", "d-M-yyyy", "d/M/yyyy", "d.M.yyyy"]


def _day(text, layout):
    """A date of one layout. A layout that does not fit costs far more than one that does, so those whose separator is not there,
    or comes too soon for a year, are not tried."""
    between = F.lit(layout.strip("dMy")[0])
    may = F.contains(text, between)
    if layout.startswith("y"):
        may = may & (F.substring(text, 2, 1) != between) & (F.substring(text, 3, 1) != between)
    return F.when(may, F.try_to_date(text, layout))


def clock(date_text, time_text):
    """Date text and time text -> TIMESTAMP_NTZ, NULL when neither layout fits."""
    day = F.coalesce(*[_day(F.trim(date_text), layout) for layout in DATE_LAYOUTS])
    return instant(F.concat_ws(" ", F.date_format(day, "yyyy-MM-dd"), F.trim(time_text)))


def instant(text):
    """ISO date and time text, with or without ``T`` and fraction -> TIMESTAMP_NTZ."""
    return F.trim(text).try_cast("timestamp_ntz")


def unit_map(json_text):
    """``{"dataheader": [{"name", "units"}]}`` -> MAP name -> units; entries lacking either are left out."""
    header = F.from_json(json_text, "dataheader array<struct<name:string,units:string>>")["dataheader"]
    whole = F.filter(header, lambda e: e["name"].isNotNull() & e["units"].isNotNull())
    # A repeated name keeps its last unit.
    names = F.array_distinct(F.transform(whole, lambda e: e["name"]))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.element_at(
        F.filter(whole, lambda e: e["name"] == n), -1)["units"]))


def underscored(names):
    """Blanks in an array of column names -> underscores."""
    return F.transform(names, lambda n: F.replace(n, F.lit(" "), F.lit("_")))
