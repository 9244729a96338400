"""Finding files, telling instruments apart, and reading text as numbered lines."""

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import Window

from fathomline.functions.text import base_name, directory, extension, stem
from fathomline.operators.sequence import CHUNK, running_sum
from fathomline.storage import list_tree, place_of, save_stage

# Extensions that may hold casts.
CAST_EXTENSIONS = (".cnv", ".txt", ".csv")
# Files up to this size are read whole, by the task that numbers their lines; longer ones in byte ranges by many tasks.
WHOLE_BYTES = 16 << 20
# What a task reads of such files, and what opening one counts for.
TASK_BYTES, OPEN_BYTES = 16 << 20, 32 << 10
# First bytes of UTF-16 text: the byte order mark of either order.
LITTLE, BIG = "UTF-16LE", "UTF-16BE"


def with_extensions(files, extensions=CAST_EXTENSIONS):
    """Rows whose lower-cased path ends with one of ``extensions``."""
    lowered = F.lower("path")
    ends = [F.endswith(lowered, F.lit(e.lower())) for e in extensions]
    keep = ends[0]
    for more in ends[1:]:
        keep = keep | more
    return files.where(keep)


def plain_path(column):
    """A path as it was written, from the form with ``%20`` for a blank that readers report."""
    return F.url_decode(F.replace(column, F.lit("+"), F.lit("%2B")))


def any_case_glob(extensions):
    """File-name pattern for extensions in any case."""
    letters = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in e.lstrip(".")) for e in extensions]
    return "*.{" + ",".join(letters) + "}"


def file_manifest(spark, directory_path, extensions=CAST_EXTENSIONS, recursive=True):
    """``(path, modificationTime, length)``; file contents are never read."""
    return with_extensions(list_tree(spark, directory_path, recursive), extensions)


def classify(files):
    """Add ``ctd_type``; the first rule that fits wins, NULL when none does."""
    path, ext, name = F.col("path"), extension(F.col("path")), base_name(F.col("path"))
    lowered = F.lower(path)
    txt = ext == ".txt"
    return files.withColumn("ctd_type", (
        F.when(ext == ".cnv", "seabird")
        .when(txt & lowered.contains("idronaut"), "idronaut")
        .when(txt & lowered.contains("_data") & F.lower(directory(path)).contains("rbr"), "rbr")
        .when((ext == ".csv") & lowered.contains("kor"), "exo")
        .when(txt & name.contains(".TXT"), "gf23")))


def rejected(files):
    """Classified files no reader takes, and why."""
    reason = F.when(F.lower("path").contains("suboceanexperiment"), "subocean").otherwise("unknown instrument")
    return files.where("ctd_type IS NULL").withColumn("reason", reason)


def find_named(files, name="logbook.csv"):
    """Files of that name in any case, in walk order."""
    return files.where(F.lower(base_name(F.col("path"))) == name.lower()).orderBy("path")


def path_parts(files):
    path = F.col("path")
    return files.withColumns({"directory": directory(path), "base_name": base_name(path), "stem": stem(path),
                              "extension": extension(path)})


def text_scan(spark, paths, glob=None):
    """Text of any encoding, cut at every byte 0x0A: ``(path, modified, _block, _id, _raw, ...)``, many tasks per file.

    The byte ends a line in UTF-8 and is half of a line's end in UTF-16, so one scan serves both; which records are whole
    lines is settled by ``numbered_lines``. Blank records and first bytes are noted here, so that counting needs no text.
    """
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    raw = reader.text(paths).select(
        plain_path(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("_block"), F.col("value").cast("binary").alias("_raw"),
        F.monotonically_increasing_id().alias("_id"))
    return raw.withColumns({
        "_size": F.octet_length("_raw").cast("bigint"),
        "_blank": F.rlike(F.col("_raw").cast("string"), F.lit(r"^[\s\x00]*$")).cast("bigint"),
        "_head": F.when(F.col("_block") == 0, F.hex(F.substring("_raw", 1, 2)))})


def read_lines(spark, paths):
    """``(path, modified, line_no, row_no, line)`` of text files of any size, UTF-8 or UTF-16 with a byte order mark."""
    return numbered_lines(text_scan(spark, paths))


def tree_lines(spark, root, extensions=CAST_EXTENSIONS):
    """Lines of every file with those extensions, in any case, under a folder: one scan for all of them."""
    return file_lines(file_manifest(spark, root, extensions))


def file_lines(listing, keep=(), whole_bytes=WHOLE_BYTES):
    """``(path, modified, *keep, line_no, row_no, line)`` of the files of a listing (``file_manifest``), as a stage table.

    ``keep`` names columns of the listing that its lines carry; a task's lines that have them in common lie together. A file of up to
    ``whole_bytes`` is read by one task, which then knows its encoding and its lines' numbers; what is longer is read as
    ``numbered_lines`` of byte ranges.
    """
    spark = listing.sparkSession
    n, size, longest = listing.agg(F.count("*"), F.sum("length"), F.max("length")).first()
    tasks = max(1, -(-((size or 0) + n * OPEN_BYTES) // TASK_BYTES))
    small = listing.where(F.col("length") <= whole_bytes).select("path", F.col("modificationTime").alias("modified"), *keep)
    # By hash: ranges would need a sample of the paths on the driver.
    small = small.repartition(tasks, "path").sortWithinPartitions(*keep, "path")
    shape = ", ".join([*(f"`{c}` {t}" for c, t in small.dtypes), "line_no bigint", "row_no bigint", "line string"])
    lines = small.mapInArrow(_whole_files, shape)
    if (longest or 0) > whole_bytes:
        large = listing.where(F.col("length") > whole_bytes).select("path", *keep)
        paths = [re.sub(r"([{}\[\]*?\\])", r"\\\1", r.path) for r in large.select("path").collect()]
        lines = lines.unionByName(numbered_lines(text_scan(spark, paths)).join(large, "path"))
    return save_stage(lines, "lines")


def _whole_files(batches):
    """The lines of whole files, ``path`` and what else a row of the listing holds before them."""
    for batch in batches:
        held, at, size = [], [], 0
        for i, path in enumerate(batch.column("path").to_pylist()):
            store, place = place_of(path)
            with store.open_input_file(place) as file:
                data = file.read()
            held.append(_text_lines(data))
            at.append(i)
            size += len(data)
            if size >= 4 << 20:
                yield _with_files(batch, at, held)
                held, at, size = [], [], 0
        if held:
            yield _with_files(batch, at, held)


def _with_files(batch, at, held):
    counts = [len(lines) for lines, _ in held]
    which = pa.array(np.repeat(at, counts))
    blanks = [np.asarray(b) for _, b in held]
    line_no = [np.arange(n) for n in counts]
    row_no = [no - np.cumsum(b) + b for no, b in zip(line_no, blanks)]
    columns = [c.take(which) for c in batch.columns]
    return pa.RecordBatch.from_arrays([
        *columns, pa.array(np.concatenate(line_no).astype(np.int64)), pa.array(np.concatenate(row_no).astype(np.int64)),
        pa.concat_arrays([lines for lines, _ in held])], [*batch.schema.names, "line_no", "row_no", "line"])


def _text_lines(data):
    """Lines of a file's bytes, and 1 for each that is blank: as ``numbered_lines`` sees them."""
    mark = {b"\xff\xfe": "utf-16-le", b"\xfe\xff": "utf-16-be"}.get(data[:2])
    if mark:
        # A last byte 0x0A without its half: the end of a line that the other half would have begun.
        if len(data) % 2:
            data = data[:-1] if data.endswith(b"\n") else data + b"\n"
        text, space = data.decode(mark), " \t\x0b\x0c\r\ufeff"
    else:
        space = " \t\x0b\x0c\r\x00"
        try:
            text = data.decode()
        except UnicodeDecodeError:
            text = "\n".join(map(_one_line, data.split(b"\n")))
    lines = pc.list_flatten(pc.split_pattern(pa.array([text], pa.string()), "\n"))
    if not lines[-1].as_py():
        lines = lines[:-1]
    blank = pc.equal(pc.utf8_length(pc.utf8_trim(lines, space)), 0).cast(pa.int64())
    for extra in "\r\ufeff":
        if extra in text:
            lines = pc.replace_substring(lines, extra, "")
    return lines, blank


def _one_line(record):
    # Bytes that are no UTF-8 are read as Latin-1, which old logger software writes for the degree and micro signs.
    try:
        return record.decode()
    except UnicodeDecodeError:
        return record.decode("latin-1")


def numbered_lines(scan):
    """Number the lines of each file of a ``text_scan``: ``line_no`` counts all lines, ``row_no`` those that are not blank.

    The scanned records are written once as a stage table, because numbers of the same scan must meet: a record's place is
    its place in the block (the records of a block come in order) plus the records of the blocks before it. Only a row per
    block is summed for that, from the columns without text. Blocks that hold blank lines are counted through in a window
    of their own; the others need no shuffle.
    """
    raw = save_stage(scan, "lines")
    before = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("path")
    blocks = raw.groupBy("path", "_block").agg(
        F.min("_id").alias("_first"), F.count("*").alias("_n"), F.sum("_blank").alias("_blanks"),
        F.sum(F.col("_size") + 1).alias("_bytes"), F.min_by("_head", "_id").alias("_mark"))

    def earlier(column):
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    mark = F.max("_mark").over(whole)
    blocks = save_stage(blocks.select(
        "path", "_block", "_first", "_blanks", earlier("_n").alias("_lines_before"), earlier("_blanks").alias("_blanks_before"),
        earlier("_bytes").alias("_bytes_before"),
        F.when(mark == "FFFE", LITTLE).when(mark == "FEFF", BIG).otherwise("UTF-8").alias("_encoding")), "blocks")
    narrow, kinds = blocks.where("_encoding = 'UTF-8'"), blocks.agg(F.max(F.col("_encoding") != "UTF-8")).first()[0]
    text = F.col("_raw").cast("string")
    # Bytes that are no UTF-8 are read as Latin-1, which old logger software writes for the degree and micro signs.
    text = F.coalesce(F.try_validate_utf8(text), F.decode("_raw", "ISO-8859-1"))
    place = F.col("_id") - F.col("_first") + F.col("_lines_before")
    shape = ["path", "modified", place.alias("line_no")]
    clean = raw.join(narrow.where("_blanks = 0"), ["path", "_block"]).select(
        *shape, (place - F.col("_blanks_before")).alias("row_no"), text.alias("line"))
    passed = Window.partitionBy("path", "_block").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    gaps = raw.join(narrow.where("_blanks > 0"), ["path", "_block"]).select(
        *shape, (place - F.col("_blanks_before") - F.coalesce(F.sum("_blank").over(passed), F.lit(0))).alias("row_no"),
        text.alias("line"))
    lines = clean.unionByName(gaps)
    if kinds:
        lines = lines.unionByName(_wide_lines(raw.join(blocks.where("_encoding <> 'UTF-8'"), ["path", "_block"])))
    return lines.withColumn("line", F.regexp_replace("line", "[\r\ufeff]", ""))


def _wide_lines(records):
    """Lines of UTF-16 files from records cut at each byte 0x0A, wherever the blocks begin.

    A cut ends a line only if the byte is the low half of an aligned unit whose high half is zero. The place of every byte
    is known from the sizes of the records before it (two levels: in the block, and per block), so each record tells on its
    own whether it opens a line (little endian: the zero comes first in it) or closes one (big endian: it ends with it).
    """
    here = Window.partitionBy("path", "_block").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("_bytes_before") + F.coalesce(F.sum(F.col("_size") + 1).over(here), F.lit(0))
    little = F.col("_encoding") == LITTLE
    zero = F.expr("X'00'")
    opens = (at == 0) | ((at % 2 == 1) & (F.substring("_raw", 1, 1) == zero))
    closes = ((at + F.col("_size")) % 2 == 1) & (F.substring("_raw", -1, 1) == zero)
    # The half unit of the line's end that stayed in the record is dropped.
    kept = F.when(little & (F.col("_mark") == 1) & (at > 0), F.substring("_raw", F.lit(2), F.length("_raw"))).when(
        ~little & (F.col("_mark") == 1), F.substring("_raw", F.lit(1), F.length("_raw") - 1)).otherwise(F.col("_raw"))
    marked = save_stage(records.withColumn("_mark", F.when(little, opens).otherwise(closes).cast("bigint")).withColumn(
        "_part", kept).select("path", "modified", "_block", "_id", "_encoding", "_mark", "_part"), "wide-records")
    before = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = marked.groupBy("path", "_block").agg(F.sum("_mark").alias("_marks")).select(
        "path", "_block", F.coalesce(F.sum("_marks").over(before), F.lit(0)).alias("_marks_before"))
    number = F.col("_marks_before") + F.coalesce(F.sum("_mark").over(here), F.lit(0)) + F.when(little, F.col("_mark") - 1).otherwise(0)
    numbered = marked.join(sums, ["path", "_block"]).withColumn("line_no", number)
    glued = F.substring(F.aggregate(
        F.array_sort(F.collect_list(F.struct("_id", "_part"))), F.expr("X''"),
        lambda done, part: F.concat(done, F.expr("X'0A'"), part["_part"])), F.lit(2), F.lit(2**31 - 1))
    lines = numbered.groupBy("path", "line_no").agg(
        F.max("modified").alias("modified"), F.max("_encoding").alias("_encoding"), glued.alias("_bytes"))
    # A file whose last byte is 0x0A without ending a line: the cut took half of its last letter.
    even = F.when(F.length("_bytes") % 2 == 1, F.concat("_bytes", F.expr("X'0A'"))).otherwise(F.col("_bytes"))
    lines = lines.select("path", "modified", "line_no", F.when(F.col("_encoding") == LITTLE, F.decode(even, LITTLE)).otherwise(
        F.decode(even, BIG)).alias("line"))
    lines = lines.withColumn("_full", F.rlike("line", F.lit(r"[^\s\ufeff]")).cast("bigint"))
    counted = running_sum(lines, ["path"], "line_no", "_full", "_upto", CHUNK)
    return counted.select("path", "modified", "line_no", (F.col("_upto") - F.col("_full")).alias("row_no"), "line")


def csv_records(lines):
    """Lines of comma tables in which a quoted cell may hold line breaks: a line that leaves a quote open takes in the
    lines up to the one that closes it, and the rows after it are counted anew.

    Only files with a line of an odd number of quotes are looked at, and where there is none the lines are returned as they
    are; a quote that is never closed leaves its lines alone.
    """
    more = [c for c in lines.columns if c not in ("path", "modified", "line_no", "row_no", "line")]
    odd = F.when(F.contains("line", F.lit('"')), (F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))) % 2).otherwise(0)
    marked = lines.withColumn("_odd", odd.cast("bigint"))
    open_files = marked.where("_odd = 1").groupBy("path").agg(
        F.max("line_no").alias("_last"), (F.count("*") % 2 == 1).alias("_unclosed")).select(
        "path", F.when(F.col("_unclosed"), F.col("_last")).alias("_stray"))
    open_files = save_stage(open_files, "open-quotes")
    if open_files.isEmpty():
        return lines
    plain = lines.join(open_files, "path", "left_anti")
    some = marked.join(open_files, "path").withColumn(
        "_odd", F.when(F.col("line_no") == F.col("_stray"), 0).otherwise(F.col("_odd")))
    some = running_sum(some, ["path"], "line_no", "_odd", "_upto", CHUNK)
    some = some.withColumn("_opens", ((F.col("_upto") - F.col("_odd")) % 2 == 0).cast("bigint"))
    some = running_sum(some, ["path"], "line_no", "_opens", "_record", CHUNK)
    joined = some.groupBy("path", "_record").agg(
        F.max("modified").alias("modified"), *[F.max(c).alias(c) for c in more], F.min("line_no").alias("line_no"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda e: e["line"]), "\n").alias("line"))
    joined = joined.withColumn("_full", (F.trim("line") != "").cast("bigint"))
    joined = running_sum(joined, ["path"], "line_no", "_full", "_rows", CHUNK)
    return plain.unionByName(joined.select(
        "path", "modified", *more, "line_no", (F.col("_rows") - F.col("_full")).alias("row_no"), "line"))


def csv_cells(line):
    """Cells of a comma-separated line: quotes around a cell are removed, doubled ones inside become one."""
    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(',("[^"]*(?:""[^"]*)*"|[^,]*)'), F.lit(1))
    return F.transform(cells, lambda c: F.when(c.startswith('"') & c.endswith('"') & (F.length(c) > 1), F.replace(
        F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))
