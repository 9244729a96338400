"""Token ids in Arrow files of equal-length sequences.

A shard holds the ids of a contiguous range of documents, in order, cut into sequences of one length: an Arrow IPC file with
two fixed-size-list columns, ``ids`` and ``mask`` (false: padding at the shard's end). Every batch but the last has the same
number of sequences and nothing is compressed, so sequence i of a memory-mapped shard is a slice at a known place: random
access copies nothing. A second Arrow file beside it lists the shard's documents with their place in the stream of ids.
"""

from __future__ import annotations

import itertools
import os
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fathomline.llm.common import fresh_path, pieces, staged, store_of

#: Ids in a sequence, and sequences in a batch of a file.
SEQUENCE, BATCH = 2048, 256
#: Runs and their characters that a worker remembers, texts that the library is asked for and runs gathered at once, bytes
#: of text encoded at once.
REMEMBERED, REMEMBERED_CHARS, ASKED, GATHERED, SLICE_BYTES = 1_200_000, 32 << 20, 500, 50_000, 6 << 20


class RunEncoder:
    """Ids of whole texts by the tokenizers library.

    The library is asked once for each distinct run: a byte-level tokenizer always starts a piece at a lone space between
    other characters, so the ids of a text are those of its runs. Runs are numbered and their ids lie side by side in one
    array, so the ids of a slice of texts are gathered by number. Texts with white space beside a space, or with a special
    token's string, go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # One thread: Spark's tasks are the parallel part, and threads of the library each keep memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special))).search if special else lambda run: None
        self.spaced = [t for t in special if " " in t]
        #: Whether a token begins with a space (which byte-level vocabularies write as the letter 256 + 32).
        self.opens = np.zeros(self.library.get_vocab_size(), bool)
        self.opens[[i for t, i in self.library.get_vocab().items() if t[0] == chr(288)]] = True
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.ids, self.begin, self.size, self.odd = np.empty(0, np.uint32), *(np.empty(0, t) for t in (np.int64, np.int64, bool))
        self.chars = 0

    def ask(self, texts: list[str], at_once: int = ASKED):
        for i in range(0, len(texts), at_once):
            for e in self.library.encode_batch_fast(texts[i:i + at_once], add_special_tokens=False):
                yield np.array(e.ids, np.uint32)

    def is_odd(self, run: str) -> bool:
        """Whether a run that a space follows keeps its text from being cut at spaces."""
        return not run or run[-1].isspace() or self.special(run) is not None

    def learn(self, new: list[str]) -> np.ndarray:
        """Numbers of new runs. Those that may stand side by side are asked for in rows: a token that begins with a space
        opens the next run."""
        # The slower test only where a special token's string stands in one of the runs.
        risky = self.special("\n".join(new))
        odd = np.array([self.is_odd(r) for r in new] if risky else [not r or r[-1].isspace() for r in new], bool)
        plain = [r for r, o in zip(new, odd.tolist()) if not o]
        made = list(self.ask(["".join([" " + r for r in plain[i:i + ASKED]]) for i in range(0, len(plain), ASKED)], 4))
        size = [np.diff(np.flatnonzero(np.append(self.opens[row], True))) for row in made]
        alone = [r for r, o in zip(new, odd.tolist()) if o]
        made += self.ask([" " + r for r in alone])
        size = np.concatenate([*size, np.fromiter(map(len, made[len(size):]), np.int64, len(alone))]).astype(np.int64)
        out = np.empty(len(new), np.int64)
        out[~odd], out[odd] = len(self.known) + np.arange(len(plain)), len(self.known) + len(plain) + np.arange(len(alone))
        self.known = pa.concat_arrays([self.known, pa.array(plain + alone, pa.string())])
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.odd = np.concatenate([self.odd, np.repeat([False, True], [len(plain), len(alone)])])
        self.ids = np.concatenate([self.ids, *made])
        self.chars += sum(map(len, new))
        return out

    def numbers(self, runs: pa.Array) -> np.ndarray:
        """Numbers of distinct runs; those known are found in Arrow, so only new ones become Python's strings."""
        place = pc.index_in(runs, value_set=self.known)
        new = place.is_null()
        out = place.fill_null(0).to_numpy().astype(np.int64)
        if place.null_count:
            out[new.to_numpy(zero_copy_only=False)] = self.learn(runs.filter(new).to_pylist())
        return out

    def gather(self, numbers: np.ndarray, width) -> np.ndarray:
        """The runs' ids in a row, some runs at a time."""
        parts = [np.empty(0, width)]
        for i in range(0, len(numbers), GATHERED):
            some = numbers[i:i + GATHERED]
            size = self.size[some]
            end = np.cumsum(size)
            parts.append(self.ids[np.repeat(self.begin[some] - end + size, size) + np.arange(end[-1])].astype(width))
        return np.concatenate(parts)

    def encode(self, texts: pa.Array, end_id: int, width) -> list[np.ndarray]:
        """Ids of every text of an Arrow column, with the end id. Texts are cut in Arrow, so each distinct run of the column
        is looked up once."""
        if len(self.known) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.forget()
        cut = pc.split_pattern(texts, " ")
        runs = cut.flatten().dictionary_encode()
        edges = np.concatenate([[0], np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))])
        index, later = runs.indices.to_numpy(), np.ones(len(runs), bool)
        later[edges[:-1]] = False
        numbers = self.numbers(runs.dictionary)[index[later]]
        first, final = (runs.dictionary.take(pa.array(index[at])).to_pylist() for at in (edges[:-1], edges[1:] - 1))
        many = np.diff(edges) - 1
        ends = np.cumsum(many)
        # Nothing follows a text's last run, so white space at its end does no harm; a special token's string does.
        odd = np.concatenate([[0], np.cumsum(self.odd[numbers])])
        heads, whole = [], []
        for i, (head, last, n, end) in enumerate(zip(first, final, many.tolist(), ends.tolist())):
            whole.append(bool(self.special(last) or n and (odd[end - 1] - odd[end - n] or head and self.is_odd(head))
                              or self.spaced and any(s in texts[i].as_py() for s in self.spaced)))
            heads.append(texts[i].as_py() if whole[-1] else head)
        body, places = self.gather(numbers, width), np.concatenate([[0], np.cumsum(self.size[numbers])])
        stop, out = np.array([end_id], width), []
        for head, w, n, end in zip(self.ask(heads), whole, many.tolist(), ends.tolist()):
            own = body[:0] if w else body[places[end - n]:places[end]]
            out.append(np.concatenate([head.astype(width), own, stop]))
        return out


#: Encoders that a worker process has made, by path: its next tasks find them, with all they remember.
_LOADED: dict[str, RunEncoder] = {}


def loaded(path: str) -> RunEncoder:
    if path not in _LOADED:
        _LOADED[path] = RunEncoder(path)
    return _LOADED[path]


class ShardWriter:
    """Writes a shard under names of its own and moves it into place at the end, so a repeated task does no harm."""

    def __init__(self, folder: str, shard: int, width, sequence: int, id_type: pa.DataType):
        self.store, self.folder = store_of(folder)
        self.store.create_dir(self.folder, recursive=True)
        self.name, self.own, self.width, self.sequence = f"shard-{shard:06d}", uuid.uuid4().hex, width, sequence
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(width), sequence)), ("mask", pa.list_(pa.bool_(), sequence))])
        self.places = pa.schema([("doc_id", id_type), ("offset", pa.int64()), ("n_tokens", pa.int64())])
        self.files = [self.store.open_output_stream(self.path(kind, True)) for kind in ("arrow", "index.arrow")]
        self.ids = pa.ipc.new_file(self.files[0], self.schema)
        self.index = pa.ipc.new_file(self.files[1], self.places)
        self.held, self.n_held, self.total, self.n_docs = [], 0, 0, 0

    def path(self, kind: str, own: bool = False) -> str:
        return f"{self.folder}/{f'_{self.own}-' if own else ''}{self.name}.{kind}"

    def add(self, doc_ids, encoded: list[np.ndarray]) -> None:
        sizes = np.array([len(e) for e in encoded], np.int64)
        self.index.write_batch(pa.record_batch([doc_ids, pa.array(self.total + np.cumsum(sizes) - sizes), pa.array(sizes)], schema=self.places))
        self.total, self.n_docs = self.total + int(sizes.sum()), self.n_docs + len(sizes)
        self.held += encoded
        self.n_held += int(sizes.sum())
        if self.n_held >= self.sequence * BATCH:
            self.flush(self.sequence * BATCH)

    def flush(self, unit: int) -> None:
        flat = np.concatenate(self.held) if self.held else np.empty(0, self.width)
        whole = len(flat) // unit * unit
        for i in range(0, whole, unit):
            self.write(flat[i:i + unit], unit)
        self.held, self.n_held = [flat[whole:].copy()], len(flat) - whole

    def write(self, flat: np.ndarray, padded: int) -> None:
        mask = np.arange(padded) < len(flat)
        values = np.concatenate([flat, np.zeros(padded - len(flat), self.width)])
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(v), self.sequence) for v in (values, mask)]
        self.ids.write_batch(pa.record_batch(columns, schema=self.schema))

    def close(self) -> dict:
        self.flush(self.sequence * BATCH)
        if self.n_held:
            self.write(self.held[0], -(-self.n_held // self.sequence) * self.sequence)
        for part in (self.ids, self.index, *self.files):
            part.close()
        for kind in ("index.arrow", "arrow"):
            self.store.move(self.path(kind, True), self.path(kind))
        return {"n_docs": self.n_docs, "n_tokens": self.total}


class ShardReader:
    """Random access to a shard: sequences and masks as views of the file, ids of a document gathered from them."""

    def __init__(self, folder: str, shard: int):
        from pyarrow import fs

        store, path = store_of(folder)
        whole = f"{path}/shard-{shard:06d}"
        opened = pa.memory_map if isinstance(store, fs.LocalFileSystem) else store.open_input_file
        self.ids = pa.ipc.open_file(opened(f"{whole}.arrow"))
        self.index = pa.ipc.open_file(opened(f"{whole}.index.arrow"))
        self.sequence = self.ids.schema.field("ids").type.list_size
        self.at, self.batch = -1, None

    def _values(self, number: int) -> np.ndarray:
        if number != self.at:
            self.at, self.batch = number, self.ids.get_batch(number).column("ids").flatten().to_numpy(zero_copy_only=True)
        return self.batch

    def sequence_at(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view of the file) and mask of sequence i."""
        batch = self.ids.get_batch(i // BATCH)
        part = [batch.column(c).slice(i % BATCH, 1).flatten() for c in ("ids", "mask")]
        return part[0].to_numpy(zero_copy_only=True), part[1].to_numpy(zero_copy_only=False)

    def ids_at(self, offset: int, n: int) -> np.ndarray:
        """Ids ``offset .. offset + n`` of the shard's stream."""
        unit = self.sequence * BATCH
        parts = [self._values(b)[max(0, offset - b * unit):offset + n - b * unit] for b in range(offset // unit, (offset + n - 1) // unit + 1)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def write_packed(docs: DataFrame, tokenizer: str, end_id: int, sequence: int = SEQUENCE, text: str = "text") -> tuple[str, DataFrame]:
    """Encode whole texts, in ascending doc_id order, into shards; returns the folder and ``shard, n_docs, n_tokens``.

    The order among rows of one id is that of their texts; rows without an id come first. NULL texts are empty: the end id only.
    """
    spark = docs.sparkSession
    folder = fresh_path(spark, "packed")
    clean = docs.select("doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("t"), F.col("t")]
    id_type = to_arrow_type(clean.schema["doc_id"].dataType)

    def write(batches):
        from pyspark import TaskContext

        shard, out = TaskContext.get().partitionId(), None
        for batch in batches:
            for piece in pieces(batch, "t", SLICE_BYTES):
                if out is None:
                    coder = loaded(tokenizer)
                    width = np.uint16 if max(end_id, coder.library.get_vocab_size() - 1) < 65536 else np.uint32
                    out = ShardWriter(folder, shard, width, sequence, id_type)
                out.add(piece.column("doc_id"), coder.encode(piece.column("t"), end_id, width))
        if out is not None:
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int64())} | {k: pa.array([v], pa.int64()) for k, v in out.close().items()})

    shards, _ = staged(clean.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
                       .mapInArrow(write, "shard long, n_docs long, n_tokens long"), "packed-shards")
    return folder, shards


def read_packed(folder: str, shards: DataFrame, id_type: str = "long") -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files.

    ``start`` counts the ids of all documents before it. Only the shards' totals (a row each) are summed in one place.
    """
    starts = shards.withColumn("before", F.coalesce(F.sum("n_tokens").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    def read(batches):
        for batch in batches:
            for shard, before in zip(batch.column("shard").to_pylist(), batch.column("before").to_pylist()):
                reader = ShardReader(folder, shard)
                for i in range(reader.index.num_record_batches):
                    index = reader.index.get_batch(i)
                    offsets, sizes = index.column("offset").to_numpy(), index.column("n_tokens").to_numpy()
                    crcs = [zlib.crc32(reader.ids_at(o, n).astype("<u4").tobytes()) for o, n in zip(offsets.tolist(), sizes.tolist())]
                    yield pa.RecordBatch.from_pydict({"doc_id": index.column("doc_id"), "start": pa.array(offsets + before),
                                                      "n_tokens": index.column("n_tokens"), "ids_crc32": pa.array(crcs, pa.int64())})

    spread = starts.select("shard", "before").repartition(max(1, shards.count()), "shard")
    return spread.mapInArrow(read, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, text: str = "text") -> DataFrame:
    """Write the files and return what reading them back gives, one row per row of ``docs``; an empty table gives none."""
    folder, shards = write_packed(docs, tokenizer, end_id, text=text)
    return read_packed(folder, shards, dict(docs.dtypes)["doc_id"])
