"""Manifest, exact search and fill-in-middle against brute force and SQL, with odd rows."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.llm import fim, kdsearch, merkle, registry

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos string, node int"
LONG = "lorem ipsum é漢\U0001f600 dolor\n" * 20_000
ODD = [None, "", " \n\t ", "a", "a", "x <P> y", "one two three", "<|endoftext|> é 漢字 \U0001f600", LONG, "<" * 5, "P>S>M>"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, [None, "", "en", "é"][i % 4], "s" if i % 2 else None, None if i % 3 else 7, "x", "y", i) for i, t in enumerate(ODD)]
    rows += [(None, "no id", "en", "s", 3, "x", "y", 0), (None, None, "en", None, None, "x", "y", 0), (3, "a", "en", "s", 1, "", "", 1)]
    rows += [(3, "a", "en", "s", 1, "", "", 1), (900, "alone", "one row", "s", 1, "", "", 1), (7, "b", None, "s", 2, "", "", 1)]
    return spark.createDataFrame(rows, DOCS).cache()


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(*values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(nodes):
    """Levels from the leaves up to the single top."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def way(levels, i):
    """Per level: the run of the node and the node's place in it."""
    out = []
    for level in levels[:-1]:
        run = i // 2 * 2
        out.append((level[run:run + 2], i - run))
        i //= 2
    return out


def manifest_by_hand(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    leaf = lambda r, more=0: h(framed(r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + more, r.text))
    for n in names:
        groups[n].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
    trees = {n: tree([leaf(r) for r in groups[n]]) for n in names}
    upper = tree([trees[n][-1][0] for n in names])
    out = []
    for g, n in enumerate(names):
        for i, r in enumerate(groups[n]):
            runs = way(trees[n], i) + way(upper, g)
            bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 0
            node = leaf(r, 1 if bad else 0)
            for run, at in runs:
                node = h(*run[:at], node, *run[at + 1:])
            proof = h(*[x for run, at in runs for k, x in enumerate(run) if k != at])
            out.append((r.doc_id, leaf(r), trees[n][-1][0], upper[-1][0], proof, node, node == upper[-1][0]))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("step", [1, 2, 8])
def test_manifest_equals_hand_made_trees(spark, odd, sf_dir, monkeypatch, step):
    monkeypatch.setattr(merkle, "STEP", step)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for docs in (odd, documents) if step > 1 else (odd,):
        got = sorted((tuple(r) for r in merkle.manifest_check(docs).select(COLUMNS).collect()), key=repr)
        assert got == manifest_by_hand(docs.collect())
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


def test_manifest_proofs_fold_to_the_root(odd):
    proofs = merkle.Manifest(odd).proofs().collect()
    assert len(proofs) == odd.count() and len({r.root for r in proofs}) == 1
    assert all(merkle.fold(r.leaf, r.path) == r.root for r in proofs)
    assert not any(merkle.fold(h("other"), r.path) == r.root for r in proofs)


def test_manifest_of_few_rows(spark, odd):
    assert merkle.manifest_check(odd.limit(0)).count() == 0
    one = merkle.manifest_check(odd.where("doc_id = 900")).first()
    assert one.leaf == one.subroot == one.root and one.proof_sha256 == h("")


def test_manifest_removes_its_stages(spark, odd):
    import os
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(folder))
    merkle.manifest_check(odd)
    assert all(n.startswith("merkle-checked") for n in set(os.listdir(folder)) - before)


def best_by_hand(rows, every, k):
    clip = lambda s: max(-2**63, min(2**63 - 1, s))
    kept = [(i, r.vec_id, [int(np.floor(1024.0 * x)) for x in r.embedding]) for i, r in enumerate(rows)
            if r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding)]
    out = []
    for i, vec_id, q in kept:
        if vec_id is None or vec_id % every:
            continue
        scored = sorted((-clip(sum(a * b for a, b in zip(q, e))), o is None, o or 0) for j, o, e in kept if j != i and len(e) == len(q))
        out += [(vec_id, n, None if missing else o, -s) for n, (s, missing, o) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard,leaf", [(10_000, 256), (60, 8), (25, 1)])
def test_search_equals_brute_force(spark, shard, leaf):
    draw = random.Random(5)
    rows = [(i, [draw.gauss(0, 0.2) for _ in range(12)], "x") for i in range(300)]
    rows += [(i, [0.5] * 12, "tie") for i in range(1000, 1030)] + [(4, [0.1, 0.2], "short"), (8, [0.3, -0.4], "short"), (12, [], "")]
    rows += [(20, None, ""), (24, [None] * 12, ""), (28, [float("nan")] * 12, ""), (32, [float("inf")] * 12, ""), (0, rows[3][1], "again"),
             (None, [0.5] * 12, "no id"), (1040, [-0.0] * 12, ""), (1044, [1.0], "alone")]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, row string").repartition(5)
    got = kdsearch.top_k(vectors, F.col("vec_id") % 4 == 0, 7, shard=shard, leaf=leaf)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect()), key=repr) == best_by_hand(vectors.collect(), 4, 7)


def test_search_of_great_numbers(spark):
    rows = [(i, [float(2**40 + i), float(-(2**41)), float(i)]) for i in range(20)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = kdsearch.top_k(vectors, F.col("vec_id") % 5 == 0, 3, leaf=4)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect()), key=repr) == best_by_hand(vectors.collect(), 5, 3)
    assert kdsearch.nearest_by_id(vectors.limit(0)).count() == 0


def test_bounds_hold_and_prune():
    draw = np.random.default_rng(3)
    vectors = np.concatenate([draw.normal(c, 5, (400, 8)).round() for c in (-300, 0, 300)])
    order, edges = kdsearch.split(vectors, 32)
    leaves = [(order[a:b].astype("<i8").tobytes(), order[a:b].astype("<i8").tobytes(), b"<f8" + vectors[order[a:b]].tobytes())
              for a, b in zip(edges, edges[1:])]
    made = kdsearch.Tree(8, *map(list, zip(*leaves)))
    q = vectors[:5]
    bounds = np.maximum(q, 0) @ made.high.T + np.minimum(q, 0) @ made.low.T
    for node in range(len(made.low)):
        depth = (node + 1).bit_length() - 1
        width = (made.first + 1) >> depth
        start = (node + 1 - (1 << depth)) * width
        inside = order[edges[start]:edges[start + width]]
        assert (vectors[inside].min(0) == made.low[node]).all() and (vectors[inside].max(0) == made.high[node]).all()
        assert (bounds[:, node] >= (q @ vectors[inside].T).max(1)).all()


def test_search_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = con.execute(kdsearch.OP12_SQL).df()
    got = registry.op12_topk(spark, sf_dir).toPandas()
    assert sorted(map(tuple, got[list(want.columns)].values)) == sorted(map(tuple, want.values)) and len(got)


def cut_by_hand(text, unit, n):
    import re
    starts = {"char": range(len(text)), "word": [m.start() for m in re.finditer(r"[^ \t\n\v\f\r]+", text)],
              "line": [0, *[i + 1 for i, c in enumerate(text[:-1]) if c == "\n"]] if text else []}[unit]
    starts = list(starts)
    place = 0 if n <= 0 else len(text) if n >= len(starts) else starts[n]
    return len(text[:place].encode()), place


@pytest.mark.parametrize("unit", ["char", "word", "line"])
def test_cuts_equal_a_plain_count(unit):
    draw = random.Random(1)
    for text in [t or "" for t in ODD] + ["".join(draw.choice("ab é漢\n \U0001f600") for _ in range(n)) for n in (1, 4096, 9000, 40_000)]:
        cuts = fim.TextCuts(text.encode(), unit)
        assert cuts.chars == len(text)
        for n in {0, 1, 2, cuts.units, cuts.units - 1, cuts.units + 1, *(draw.randrange(cuts.units + 1) for _ in range(8))}:
            assert cuts.cut(n) == cut_by_hand(text, unit, n)


def fim_by_hand(r):
    text = r.text or ""
    d = hashlib.sha256(f"1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[i:i + 8], 16) for i in range(0, 32, 8))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return r.doc_id, len(text), "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    spm = h4 % 100 < 20
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return r.doc_id, len(text), "spm" if spm else "psm", a, b - a, sha(out), sha(text)


def test_fim_equals_plain_slices(spark, odd, sf_dir):
    for docs in (odd, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        got = sorted(map(tuple, fim.fim_digests(docs).collect()), key=repr)
        assert got == sorted(map(fim_by_hand, docs.collect()), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert fim.fim_digests(odd.limit(0)).count() == 0


@pytest.mark.parametrize("unit", ["word", "line"])
def test_fim_in_other_units_is_restored(odd, unit):
    made = fim.fill_in_middle(odd, seed="7", unit=unit, plain_from=100, spm_below=50)
    back = sorted((str(r.doc_id), r.t) for r in made.select("doc_id", fim.restored().alias("t")).collect())
    assert back == sorted((str(r.doc_id), r.text or "") for r in odd.collect())


def test_fim_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(fim.OP13_SQL).fetchall()
    assert sorted(map(tuple, registry.op13_fim(spark, sf_dir).collect())) == sorted(want)
