"""Stage tables in the shared folder of the cluster.

Lineage is cut by writing a Parquet table, not by a local checkpoint: an executor that is lost takes nothing with it,
and a later read still prunes columns and skips row groups.
"""

import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import functions as F

# Open ``recorded`` blocks, innermost last; each lists the paths of the stage tables written in it.
_BLOCKS = []


def shared_dir(spark):
    """Folder for stage tables: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Only a local session that names neither gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="fathomline-"))
    return context.getCheckpointDir().rstrip("/")


def stage_path(spark, label):
    """A fresh path in the shared folder; fresh, so a rerun never reads half of an older table."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    for block in _BLOCKS:
        block.append(path)
    return path


@contextmanager
def recorded():
    """The list of stage paths handed out inside the block, to be removed once nothing reads them any more."""
    block = []
    _BLOCKS.append(block)
    try:
        yield block
    finally:
        _BLOCKS.pop()


def remove_stages(spark, paths):
    """Remove stage tables, with the file system Spark itself uses for them; paths that are gone already do no harm."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def save_stage(df, label):
    """Write ``df`` as a stage table and return the table read back."""
    path = stage_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_buckets(df, label, key, n):
    """Like ``save_stage`` for rows that lie in ``n`` partitions by ``key``: the table read back keeps them there, so windows,
    joins and groups by ``key`` need no shuffle.

    The key has another name in the table: an alias drops the table's name from it, without which a union does not see that its
    sides lie alike.
    """
    path = stage_path(df.sparkSession, label)
    name = path.rpartition("/")[2].replace("-", "_")
    df.withColumnRenamed(key, "_bucket_key").write.bucketBy(n, "_bucket_key").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name).withColumnRenamed("_bucket_key", key)


# What a folder of a value may not have in its name, as Spark's writers see it, and the folder of a missing value.
_ESCAPED = {c: f"%{c:02X}" for c in [*range(1, 0x20), 0x7F, *map(ord, "\"#%'*/:=?\\{[]^")]}
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def store_of(folder):
    """Arrow's file system for a folder as Spark names it, and the path in it, for tasks that write files of given names."""
    from pyarrow import fs

    scheme, mark, rest = folder.partition("://")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + mark + rest)


def place_of(path):
    """Arrow's file system for a file or folder of any name, as Spark names it, and the path in it."""
    from pyarrow import fs

    scheme, mark, rest = path.partition("://")
    if scheme == "file" or not mark:
        return fs.LocalFileSystem(), f"/{rest.lstrip('/')}" if mark else path.removeprefix("file:")
    host, _, inner = rest.partition("/")
    store, base = store_of(f"{scheme}://{host}/")
    return store, f"{base.rstrip('/')}/{inner}"


# Folders that one listing task takes, and the most tasks for a level of a tree.
FOLDERS_PER_TASK, LISTING_TASKS = 64, 200
_LISTED = "path string, folder boolean, modificationTime timestamp, length bigint"


def list_tree(spark, root, recursive=True):
    """``(path, modificationTime, length)`` of the files under a folder (or of those that a pattern names), level by level.

    The tasks list the folders, so neither the number of files nor that of folders meets the driver. Names that Spark's readers
    leave out (``_temporary``, ``.x.crc``) are left out, and empty files, as by those.
    """
    def hidden(name):
        return (name.startswith((".", "_")) and not (name.startswith("_") and "=" in name) and not name.startswith(
            ("_metadata", "_common_metadata"))) or name.endswith("._COPYING_")

    def write(batches):
        from pyarrow import fs

        schema = pa.schema([("path", pa.string()), ("folder", pa.bool_()), ("modificationTime", pa.timestamp("us", "UTC")), ("length", pa.int64())])
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                store, place = place_of(folder)
                infos = [store.get_file_info(place)]
                if infos[0].type == fs.FileType.Directory:
                    infos = store.get_file_info(fs.FileSelector(place))
                    paths = [f"{folder.rstrip('/')}/{i.base_name}" for i in infos]
                else:
                    paths = [folder]
                for start in range(0, len(infos), 50_000):
                    some = [(p, i) for p, i in zip(paths[start:start + 50_000], infos[start:start + 50_000])
                            if i.type in (fs.FileType.File, fs.FileType.Directory) and not hidden(i.base_name)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([p for p, _ in some], pa.string()), pa.array([i.type == fs.FileType.Directory for _, i in some], pa.bool_()),
                        pa.array([(i.mtime_ns or 0) // 1_000_000 * 1000 for _, i in some], pa.int64()).cast(schema.field(2).type),
                        pa.array([i.size or 0 for _, i in some], pa.int64())], schema=schema)

    named = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = named.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(named)
    if not found:
        raise FileNotFoundError(root)
    folders = spark.createDataFrame([(status.getPath().toString(),) for status in found], "path string")
    files, n = None, len(found)
    while n:
        tasks = min(LISTING_TASKS, -(-n // FOLDERS_PER_TASK))
        level = save_stage(folders.repartition(tasks, "path").mapInArrow(write, _LISTED), "listing")
        mine = level.where("not folder and length > 0").drop("folder")
        files = mine if files is None else files.unionByName(mine)
        folders = level.where("folder").select("path")
        n = folders.count() if recursive else 0
    return files


def _runs(batch):
    """The rows of a batch ``(file, value)`` that follow each other under one name: the name, and their values a line each."""
    files, values = batch.column("file"), pc.fill_null(batch.column("value").cast(pa.binary()), b"")
    start = 0
    for end in pc.run_end_encode(files).run_ends.to_pylist() if len(files) else []:
        lines = pa.ListArray.from_arrays(pa.array([0, end - start], pa.int32()), values.slice(start, end - start))
        yield files[start].as_py(), pc.binary_join(lines, b"\n")[0].as_py() + b"\n"
        start = end


def save_named_files(rows, root):
    """Write ``(file, line_no, value)`` as text files of those names under ``root``, a line each, in the order of ``line_no``.

    The tasks write the files themselves, line by line, so neither their number nor a file's size meets the driver. A file is
    written beside the tree and moved into it when it is whole; a task that runs again replaces it. Rows without a name are
    left out.
    """
    scratch = f"{root}-parts"

    def write(batches):
        store, place = store_of(root)
        beside = store_of(scratch)[1]
        store.create_dir(beside)
        name = out = part = None

        def close():
            if out is not None:
                out.close()
                store.create_dir(f"{place}/{name}".rpartition("/")[0])
                store.move(part, f"{place}/{name}")

        done = 0
        for batch in batches:
            for file, lines in _runs(batch):
                if file != name:
                    close()
                    name, part = file, f"{beside}/{uuid.uuid4().hex}"
                    out, done = store.open_output_stream(part), done + 1
                out.write(lines)
        close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([done], pa.int64())})

    spark = rows.sparkSession
    named = rows.where("file <> ''").repartition("file").sortWithinPartitions("file", "line_no")
    named = named.select("file", F.col("value").cast("binary").alias("value"))
    named.mapInArrow(write, "files bigint").agg(F.sum("files")).collect()
    remove_stages(spark, [scratch])


def save_sorted_files(rows, root, header, extension, column="file"):
    """Write ``(file, value)`` as text, a folder ``<column>=<name>`` each under ``root``, in the order the rows of a partition have.

    A partition's rows of one file are a part of it, named by the partition's number, after a ``header`` line. The tasks write
    the parts themselves, beside the tree and then moved into it; a task that runs again replaces its own.
    """
    scratch = f"{root}-parts"
    place = rows.sparkSession._jvm.org.apache.hadoop.fs.Path(root)
    place.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration()).mkdirs(place)

    def write(batches):
        number = TaskContext.get().partitionId()
        store, place = store_of(root)
        beside = f"{store_of(scratch)[1]}/{uuid.uuid4().hex}"
        store.create_dir(beside)
        name = out = None
        done = 0

        def close():
            if out is not None:
                out.close()
                folder = f"{place}/{column}={(name or '').translate(_ESCAPED) or _NO_VALUE}"
                store.create_dir(folder)
                store.move(f"{beside}/{done}", f"{folder}/part-{number:05d}.{extension}")

        for batch in batches:
            for mine, lines in _runs(batch):
                if out is None or mine != name:
                    close()
                    name, done = mine, done + 1
                    out = store.open_output_stream(f"{beside}/{done}")
                    out.write(header.encode() + b"\n")
                out.write(lines)
        close()
        yield pa.RecordBatch.from_pydict({"files": pa.array([done], pa.int64())})

    rows.select("file", "value").mapInArrow(write, "files bigint").agg(F.sum("files")).collect()
    remove_stages(rows.sparkSession, [scratch])
