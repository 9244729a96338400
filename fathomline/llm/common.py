"""What the operators share: reading tables, stage tables, batches cut by bytes, bounded labelled samples."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.storage import stage_path

#: Text worked on at once inside a task; a longer text is a piece of its own.
PIECE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share, as a URI or as the session names it."""
    return stage_path(spark, label)


def staged(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def store_of(folder: str):
    """Arrow's file system for a folder as Spark names it, and the path in it. Spark's connectors for one store have schemes
    of their own."""
    from pyarrow import fs

    scheme, mark, rest = folder.partition("://")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + mark + rest)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Remove a stage table of this run that no later read needs."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def same_key(left, right):
    """Equality that also matches NULL with NULL."""
    return left.eqNullSafe(right)


def held_out(doc_id="doc_id"):
    """True for the third of the documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def pieces(batch: pa.RecordBatch, column: str, most: int = PIECE_BYTES):
    """Slices of an Arrow batch with at most ``most`` bytes of text each, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def map_texts(docs: DataFrame, keep: list[str], text: str, work, schema: str, state=None) -> DataFrame:
    """``work(texts, state)`` over slices of whole texts in Arrow batches, beside the columns to keep.

    ``work`` gets a list of texts (NULL is '') and returns a dict of columns; ``state()`` runs once per task.
    """
    columns = [F.col(c) for c in keep]
    source = docs.select(*columns, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    types = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]), schema])

    def run(batches):
        own = state() if state else None
        for batch in batches:
            for piece in pieces(batch, "__text"):
                made = work(piece.column("__text").to_pylist(), own)
                kept = {c: piece.column(c) for c in keep}
                yield pa.RecordBatch.from_pydict(kept | {k: v if isinstance(v, pa.Array) else pa.array(v)
                                                         for k, v in made.items()})

    return source.mapInArrow(run, types)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, longest: int, text: str = "text"):
    """A bounded sample of labelled texts on the driver: ``[(text, 0 or 1)]``.

    The ids of at most ``per_class`` labelled rows of each class that are not held out, by a hash of the id, so the sample is
    the same in every run; then those of their texts with at most ``longest`` characters. The ids are few by construction
    and are broadcast, so no text moves but the sample's.
    """
    marked = (labels.where(F.col(label).isin(0, 1) & ~held_out() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    chosen = [r for y in (0, 1) for r in marked.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()]
    if not chosen:
        return []
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["y"]) for r in chosen], marked.schema)
    known = docs.select("doc_id", F.col(text).alias("t")).where(F.length("t").between(1, longest)).join(F.broadcast(ids), "doc_id")
    # An id may be repeated in the documents: still no more than two texts for each id in all.
    rows = known.orderBy("y", F.xxhash64("doc_id"), "doc_id", "t").limit(4 * per_class).collect()
    return [(r["t"], r["y"]) for r in rows]
