"""WARC files: written by tasks, read back in ranges with verified record boundaries.

Reading: a task takes a range of a file and looks for the version line that opens a record. The line may also stand inside
a payload, so a place is only a candidate: its header names a length, hence a successor. Within the range candidates are
chained to the first successor beyond it; these exits are joined to the next ranges' candidates, and pointer jumping from
the file's start (each round doubles the step) keeps what can be reached. No file is read front to back by one task.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import drop_stage, fresh_path, same_key, staged, store_of

VERSION = b"WARC/1.1\r\n"
#: Bytes after which a writer starts a new file, and bytes of a range that one task reads.
FILE_BYTES, RANGE_BYTES = 64 << 20, 8 << 20
#: Bytes read beyond a range for the header of its last candidate, to begin with.
HEADER_BYTES = 16 << 10
#: Fixed value: the date of all records, so that equal input gives equal files.
DATE = "2024-01-01T00:00:00Z"


def bare_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, size: int, digest: str, refers_to) -> bytes:
    """One record; a revisit has the digest and length of its payload, not the payload."""
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"), ("WARC-Date", DATE),
            ("WARC-Target-URI", "" if url is None else " ".join(url.split())), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("X-Payload-Length", str(size))]
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    head += [("Content-Type", "text/html"), ("Content-Length", str(len(body)))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + body + b"\r\n\r\n"


#: What ``header`` answers when the data end within the header.
CUT_OFF = "cut off"


def header(data: bytes, at: int):
    """Header fields of the candidate at ``at`` and where its block starts; None if it is no header. Lines are read one by one
    up to the first that cannot stand there, so a payload full of version lines is not read again for each of them."""
    fields, place = {}, at + len(VERSION)
    while (end := data.find(b"\r\n", place)) >= 0:
        if end == place:
            length = fields.get(b"content-length", b"")
            return (fields, end + 2) if length.isdigit() else None
        name, colon, value = data[place:end].partition(b":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
        place = end + 2
    return CUT_OFF


def decide(pages: DataFrame, least: int) -> DataFrame:
    """``page_id, url, packed payload, digest, size, refers_to``: of equal payloads that of the largest page_id is kept.

    Digests are grouped with a partial maximum, so a group that holds a third of all rows is small before it moves. The
    payload travels compressed, once.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    slim = pages.select("page_id", "url", html.alias("payload"))

    def shrink(batches):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            payloads = batch.column("payload").to_pylist()
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"), "url": batch.column("url"), "packed": pa.array([squeeze(p) for p in payloads], pa.binary()),
                "size": pa.array([len(p) for p in payloads], pa.int64()), "digest": pa.array([bare_digest(p) for p in payloads])})

    kinds = dict(pages.dtypes)
    digests = slim.select("page_id", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("size")).where(F.col("size") >= least)
    groups = digests.groupBy("sha1", "size").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).where("n > 1")
    packed = slim.mapInArrow(shrink, f"page_id {kinds['page_id']}, url string, packed binary, size long, digest string")
    shown = groups.select(F.col("sha1"), F.col("size").cast("long").alias("of_size"), "kept")

    def base32(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"of": pa.array([base64.b32encode(bytes.fromhex(x)).decode() for x in batch.column("sha1").to_pylist()], pa.string()),
                                              "of_size": batch.column("of_size"), "kept": batch.column("kept")})

    # Written, so that the planner knows how few groups there are and, if so, leaves the payloads where they are.
    shown, _ = staged(shown.mapInArrow(base32, f"of string, of_size long, kept {kinds['page_id']}"), "warc-groups")
    joined = packed.join(shown, (packed["digest"] == shown["of"]) & (packed["size"] == shown["of_size"]), "left")
    return joined.select("page_id", "url", "packed", "size", "digest",
                         F.when(~same_key(F.col("page_id"), F.col("kept")), F.col("kept")).alias("refers_to"))


def write_archives(pages: DataFrame, least: int = 0) -> tuple[str, DataFrame]:
    """A WARC record per row of ``pages``; returns the folder and ``file, bytes``.

    A file's name is its own, so a task that runs twice replaces nothing: the table lists the files of the attempt that
    Spark accepted, and only those are read.
    """
    folder = fresh_path(pages.sparkSession, "warc")

    def write(batches):
        from pyspark import TaskContext

        store, path = store_of(folder)
        store.create_dir(path, recursive=True)
        part, made, out, size, own = TaskContext.get().partitionId(), [], None, 0, None
        expand = zstandard.ZstdDecompressor().decompress

        def close():
            out.close()
            made.append((own, size))

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    own, size = f"part-{part:06d}-{uuid.uuid4().hex}.warc", 0
                    out = store.open_output_stream(f"{path}/{own}")
                # An empty payload compresses to a frame without content.
                payload = expand(row["packed"]) if row["size"] and row["refers_to"] is None else b""
                data = record(row["page_id"], row["url"], payload, row["size"], row["digest"], row["refers_to"])
                out.write(data)
                size += len(data)
                if size >= FILE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pydict({"file": pa.array([f for f, _ in made], pa.string()), "bytes": pa.array([n for _, n in made], pa.int64())})

    files, _ = staged(decide(pages, least).mapInArrow(write, "file string, bytes long"), "warc-files")
    return folder, files


def scan_ranges(folder: str, files: DataFrame) -> DataFrame:
    """Candidates: ``file, start, successor, exit`` and the fields of the header; ``exit`` is the chain's end beyond the range."""
    ranges = files.where("bytes > 0").select("file", "bytes", F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(RANGE_BYTES))).alias("begin"))
    many = max(1, ranges.count())

    def scan(batches):
        store, path = store_of(folder)
        for batch in batches:
            for row in batch.to_pylist():
                begin, stop = row["begin"], min(row["begin"] + RANGE_BYTES, row["bytes"])
                with store.open_input_file(f"{path}/{row['file']}") as source:
                    data = source.read_at(min(stop + HEADER_BYTES, row["bytes"]) - begin, begin)
                    out, at = [], data.find(VERSION)
                    while 0 <= at < stop - begin:
                        while (found := header(data, at)) is CUT_OFF and begin + len(data) < row["bytes"]:
                            # A header may run on for any length: read as much again.
                            data += source.read_at(min(len(data), row["bytes"] - begin - len(data)), begin + len(data))
                        if found and found is not CUT_OFF:
                            fields, block = found
                            out.append((begin + at, begin + block + int(fields[b"content-length"]) + 4, fields))
                        at = data.find(VERSION, at + 1)
                exits = {}
                for start, after, _ in reversed(out):
                    # A successor within the range that is no candidate leads nowhere.
                    exits[start] = exits.get(after, -1) if after < stop else after
                text = lambda f, k: f.get(k, b"").decode("utf-8", "replace")
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([row["file"]] * len(out), pa.string()), "begin": pa.array([begin] * len(out), pa.int64()), "start": pa.array([s for s, _, _ in out], pa.int64()),
                    "successor": pa.array([a for _, a, _ in out], pa.int64()), "exit": pa.array([exits[s] for s, _, _ in out], pa.int64()),
                    "record_type": pa.array([text(f, b"warc-type") for _, _, f in out], pa.string()), "record_id": pa.array([text(f, b"warc-record-id") for _, _, f in out], pa.string()),
                    "digest": pa.array([text(f, b"warc-payload-digest") for _, _, f in out], pa.string()), "size": pa.array([text(f, b"x-payload-length") for _, _, f in out], pa.string()),
                    "refers": pa.array([text(f, b"warc-refers-to") for _, _, f in out], pa.string())})

    schema = "file string, begin long, start long, successor long, exit long, record_type string, record_id string, digest string, size string, refers string"
    return ranges.repartition(many, "file", "begin").mapInArrow(scan, schema)


def verified(candidates: DataFrame, files: DataFrame) -> DataFrame:
    """The candidates that can be reached from the start of their file."""
    spark, span = candidates.sparkSession, files.agg(F.max("bytes")).first()[0] or 0
    jump = candidates.select("file", "start", "exit")
    entered, entered_path = staged(jump.where("start = 0").select("file", "start"), "warc-entered")
    steps, old = 1, None
    while steps * RANGE_BYTES < span:
        step = jump.select("file", F.col("start").alias("at"), "exit")
        onward = entered.join(step, (entered["file"] == step["file"]) & (entered["start"] == step["at"])).select(step["file"], F.col("exit").alias("start"))
        more, more_path = staged(entered.unionByName(onward).distinct(), "warc-entered")
        second = jump.select(F.col("file").alias("of"), F.col("start").alias("at"), F.col("exit").alias("further"))
        doubled, path = staged(jump.join(second, (jump["file"] == second["of"]) & (jump["exit"] == second["at"])).select("file", "start", F.col("further").alias("exit")), "warc-jump")
        for gone in (entered_path, old):
            if gone:
                drop_stage(spark, gone)
        entered, entered_path, jump, old, steps = more, more_path, doubled, path, steps * 2
    # Inside a range, records follow from its entry by their successors.
    entry = entered.select(F.col("file").alias("of"), F.col("start").alias("entry"))
    marked = candidates.join(entry, (candidates["file"] == entry["of"]) & (candidates["start"] == entry["entry"]), "left")

    def follow(batch: pa.Table) -> pa.Table:
        start, successor = batch.column("start").to_numpy(), batch.column("successor").to_numpy()
        place = {s: i for i, s in enumerate(start.tolist())}
        keep, todo = np.zeros(len(start), bool), np.flatnonzero(~np.isnan(batch.column("entry").to_numpy(zero_copy_only=False).astype(float))).tolist()
        while todo:
            i = todo.pop()
            if not keep[i]:
                keep[i] = True
                if (after := place.get(int(successor[i]))) is not None:
                    todo.append(after)
        return batch.drop_columns(["of"]).filter(pa.array(keep))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in marked.schema if f.name != "of")
    return marked.groupBy("file", "begin").applyInArrow(follow, schema)


def read_archives(folder: str, files: DataFrame) -> DataFrame:
    """The records of the archives: their kind, page, payload length and digest."""
    candidates, _ = staged(scan_ranges(folder, files), "warc-candidates")
    page = lambda c: F.nullif(F.regexp_extract(c, r"^<urn:page:(.*)>$", 1), F.lit(""))
    return verified(candidates, files).select(
        page("record_id").alias("page_id"), F.col("size").cast("long").alias("payload_bytes"),
        F.regexp_replace("digest", "^sha1:", "").alias("payload_digest"), "record_type", page("refers").alias("refers_to"))


def archive(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write, read back: ``page_id, payload_bytes, payload_digest, record_type, refers_to`` per row of ``pages``.

    NULL html is an empty payload. Of equal payloads of at least ``least`` bytes the row with the largest page_id is the
    response; rows repeated with that id are responses too. A NULL page_id is never referred to, unless no row of the group
    has an id: then all are responses. An empty table gives no rows; other columns are ignored.
    """
    folder, files = write_archives(pages, least)
    kind = dict(pages.dtypes)["page_id"]
    return read_archives(folder, files).select(F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind))

