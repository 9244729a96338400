"""Long headers, forged headers, many distinct words, control characters, prefix answers, clashing columns, repeated ids."""

import itertools
import random
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fathomline.llm import common, mixing, packing, quality, registry, simhash, tokens, warc

tokenizers = pytest.importorskip("tokenizers")


def test_headers_of_any_length(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 50_000)
    rows = [(i, f"http://x/{i}/" + "u" * 60_000, f"<p>{i % 7}") for i in range(40)]
    got = warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert sorted(r.page_id for r in got) == list(range(40))


def test_forged_headers_are_read_once():
    data = warc.VERSION * 40_000 + b"Content-Length: 1\r\n\r\nx"
    start = time.time()
    found = [warc.header(data, i * len(warc.VERSION)) for i in range(40_000)]
    assert time.time() - start < 2 and found[:-1] == [None] * 39_999 and found[-1][0] == {b"content-length": b"1"}
    assert warc.header(warc.VERSION + b"A: b\r\nContent", 0) is warc.CUT_OFF


def windows_by_hand(numbers):
    where = {}
    for i in range(len(numbers) - 2):
        where.setdefault(tuple(numbers[i:i + 3]), []).append(i)
    return len({i + k for v in where.values() if len(v) > 1 for i in v for k in range(3)})


def test_repeats_among_many_distinct_words():
    big = 1 << 21
    draw = np.random.default_rng(1)
    long = np.arange(big + 5)
    for numbers in ([0, big, 5, 9, 1, 0, 5], [big, 1, 2, big, 1, 2, 7], (draw.integers(0, 6, 300) * (big - 1)).tolist()):
        assert quality.repeated_words(np.array(numbers)) == windows_by_hand(numbers)
    assert quality.repeated_words(np.concatenate([long, [3, 4, 5]])) == 6


@pytest.fixture(scope="module")
def bpe():
    return tokens.PrefixBpe(registry.tokenizer_path())


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(registry.tokenizer_path())


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch_fast(texts, add_special_tokens=False)]


def random_texts(letters, n, longest, seed=0):
    draw = random.Random(seed)
    return ["".join(draw.choice(letters) for _ in range(draw.randrange(longest))) for _ in range(n)]


LETTERS = [*"ab é漢\n\t 's_.,12", "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\u2003", "ǅ", "²", "\u0301", "<|endoftext|>", "\U0001f600", "'ll", "  "]


def test_counts_and_ids_equal_the_library_on_random_texts(bpe, library):
    texts = random_texts(LETTERS, 6000, 25) + ["a\x1c's it", "", " ", "x" * 500, "é" * 300 + " " + "z" * 49]
    assert bpe.counts(pa.array(texts)).tolist() == lengths(library, texts)
    coder = packing.RunEncoder(registry.tokenizer_path())
    want = [[*e.ids, 2] for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [e.tolist() for e in coder.encode(pa.array(texts), 2, np.uint32)] == want


def test_tables_of_many_pieces_equal_one_by_one(bpe):
    words = [w.encode() for w in random_texts("abcdefghiéoust漢", 800, 20, 3) if w]
    made = bpe.tables.counts(words)
    for i, w in enumerate(words):
        assert made[:len(w) + 1, i].tolist() == bpe.piece_table(w)[0]
    assert bpe.tables.totals(words).tolist() == [bpe.piece_table(w)[0][-1] for w in words]


def test_prefix_answers_at_every_cut(spark, bpe, library):
    texts = random_texts(LETTERS, 60, 25, 5) + ["It's  a  test of   prefixes, isn't it? 12,345\n\n done", ""]
    for text in texts:
        ends, totals = bpe.text_table(text)
        want = lengths(library, [text[:k] for k in range(len(text) + 1)])
        assert [bpe.count_at(text, ends, totals, k) for k in range(len(text) + 1)] == want
        for budget in range(len(totals) + 2):
            cut = bpe.truncate(text, ends, totals, budget)
            assert cut in (0, *ends.tolist()) and (not cut or totals[ends.tolist().index(cut)] <= budget)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "doc_id long, text string")
    got = {r.doc_id: (r.ends, r.totals) for r in tokens.prefix_tables(rows, registry.tokenizer_path()).collect()}
    assert got[99] == ([], []) and all(got[i] == tuple(x.tolist() for x in bpe.text_table(t)) for i, t in enumerate(texts))


def test_packing_and_counts_equal_the_library_on_the_table(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    ids = [[*e.ids, 2] for e in library.encode_batch_fast([r.text or "" for r in docs], add_special_tokens=False)]
    starts = np.cumsum([0, *map(len, ids)])
    packed = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in registry.op7_packing(spark, sf_dir).collect()}
    counted = {r.doc_id: r.n_tokens for r in registry.op8_token_counts(spark, sf_dir).collect()}
    for r, own, start in zip(docs, ids, starts.tolist()):
        assert packed[r.doc_id] == (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        assert counted[r.doc_id] == len(own) - 1


def test_random_access_to_sequences(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    folder, shards = packing.write_packed(docs, registry.tokenizer_path(), 2, sequence=64)
    texts = [r.text or "" for r in docs.orderBy("doc_id").collect()]
    stream = list(itertools.chain.from_iterable([*e.ids, 2] for e in library.encode_batch_fast(texts, add_special_tokens=False)))
    before = 0
    for shard in shards.orderBy("shard").collect():
        reader, own = packing.ShardReader(folder, shard.shard), stream[before:before + shard.n_tokens]
        for i in {0, 1, (shard.n_tokens - 1) // 64}:
            ids, mask = reader.sequence_at(i)
            assert ids[mask].tolist() == own[i * 64:(i + 1) * 64] and len(ids) == 64
        before += shard.n_tokens
    assert before == len(stream)


def test_ids_of_other_types(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b c")], "doc_id long, text string")
    for kind in ("smallint", "decimal(10,0)", "date"):
        some = rows.withColumn("doc_id", F.col("doc_id").cast(kind) if kind != "date" else F.date_add(F.lit("2024-01-01"), F.col("doc_id").cast("int")))
        assert packing.pack(some, registry.tokenizer_path()).count() == 2


def near_prints(n, seed):
    """Fingerprints of which many lie in chains and dense groups, as signed numbers."""
    draw, out = random.Random(seed), [0]
    while len(out) < n:
        one = draw.getrandbits(64) if draw.random() < 0.4 else out[draw.randrange(len(out))]
        if draw.random() < 0.3:
            one &= 2 ** 20 - 1      # a hot part: the upper bits of a third are the same
        for _ in range(draw.randrange(6)):
            one ^= 1 << draw.randrange(64)
        out.append(one)
    return sorted({v - 2 ** 64 if v >= 2 ** 63 else v for v in out})


def brute_roots(prints, limit):
    at, root = np.array(prints, np.int64).view(np.uint64), list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(at[i + 1:] ^ at[i]) <= limit):
            a, b = sorted((find(i), find(i + 1 + int(j))))
            root[b] = a
    return {p: prints[find(i)] for i, p in enumerate(prints)}


@pytest.mark.parametrize("group, limit", [(16384, 3), (300, 3), (300, 0), (64, 1), (16384, 5)])
def test_nodes_of_any_size(spark, monkeypatch, group, limit):
    """Upper nodes divided never, once and several times, small and large ones: the components of brute force."""
    monkeypatch.setattr(simhash, "GROUP", group)
    monkeypatch.setattr(simhash, "AT_ONCE", 500)
    prints = near_prints(2500, seed=limit)
    fps = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = {r.node: r.root for r in simhash.components(simhash.links(fps, limit)).collect()}
    want = brute_roots(prints, limit)
    assert {p: got.get(p, p) for p in prints} == want
    assert limit == 0 or len(set(want.values())) < len(prints)


def test_nodes_cover_every_pair():
    """Two patterns within the limit share a part wholly, at every level."""
    for mask in (0, 0xFFFF, 0xFFFF0000FFFF0000, 2 ** 64 - 1 - 0b111111):
        children = simhash.parts_of(mask, 4)
        assert all(c & mask == mask for c in children) and len(children) == 4
        free = [c & ~mask for c in children]
        assert sum(free) == 2 ** 64 - 1 - mask and all(not x & y for i, x in enumerate(free) for y in free[:i])


def test_moved_rows_grow_with_the_input_only(spark, monkeypatch):
    """Rows sent to the nodes for each fingerprint: the same at four times as many."""
    sent = []
    real = simhash.searched
    monkeypatch.setattr(simhash, "searched", lambda rows, limit: (sent.append(rows.count()), real(rows, limit))[1])
    for n in (500, 2000):
        simhash.links(spark.range(n).select(F.xxhash64("id").alias("fp")), 3)
    assert sent == [2000, 8000]


def test_near_duplicates_keep_clashing_columns(spark):
    rows = [(1, "a b c", "x", 1), (2, "a b c", "y", 2), (None, "a b c", "z", 3), (None, "q r s t", "v", 4), (None, "q r s t", "v", 4), (None, None, "w", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, root int")
    got = simhash.simhash_dedup(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.fp, r.root) for r in got.collect()) == [(0, "v", 4), (0, "w", 5), (1, "x", 1)]


def test_mixture_takes_texts_of_one_id_each_for_itself(spark):
    rows = [(i % 4, f"{'w ' * (i % 5 + 1)}{i}", "s" if i % 3 else None) for i in range(40)] + [(None, None, "t"), (1, "twice", "s"), (1, "twice", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    marked = docs.withColumn("d", F.xxhash64("text"))
    for budget in (None, 60.0):
        made = mixing.remix(docs, max_repeat=1.5, budget=budget)
        want = {}
        for r in mixing.copies(marked.withColumnRenamed("d", "__digest"), ["doc_id", "__digest"], max_repeat=1.5, budget=budget).collect():
            want.setdefault((r.doc_id, r.source, r["__digest"]), []).append(r.copies)
        got = {}
        for r in made.withColumn("d", F.xxhash64("text")).collect():
            got[r.doc_id, r.source, r.d] = got.get((r.doc_id, r.source, r.d), 0) + 1
        assert got == {k: max(v) * len(v) for k, v in want.items() if max(v)}


def test_stores_by_spark_scheme():
    store, path = common.store_of("file:///tmp/x")
    assert path == "/tmp/x"
    from pyarrow import fs
    try:
        assert isinstance(common.store_of("s3a://bucket/x")[0], fs.S3FileSystem)
    except OSError as error:  # no network to look the bucket's region up
        assert "scheme" not in str(error)


