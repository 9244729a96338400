"""Operators of the training-data package on small fixtures: brute force, round trips, defined results for odd rows."""

import base64
import hashlib
import html
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

from fathomline.llm import decontaminate, licences, mixing, packing, pagetext, quality, registry, simhash, tokens, toxicity, warc

tokenizers = pytest.importorskip("tokenizers")

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, words string, text_id int"
LONG = "lorem ipsum dolor sit amet " * 20_000
ODD = [None, "", " \n\t ", "a", "a", "the MIT License under the mit license:", "one two three four five six seven",
       "<|endoftext|> é 漢字 \U0001f600", LONG]
LABELS = "doc_id long, toxic int, quality int, extra string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None, "s" if i % 2 else None, None, "x", "y", i) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows, DOCS).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(0, 1, 1, None), (3, 0, 0, None), (5, None, None, ""), (6, 1, 0, ""), (None, 1, 1, "")], LABELS)


@pytest.fixture(scope="module")
def corpus(spark, sf_dir):
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "pages", "labels", "benchmark")}


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints):
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_simhash_equals_brute_force(spark, odd):
    base = " ".join(f"w{i}" for i in range(400))
    texts = [*ODD[:-1], "lorem ipsum " * 50, base, base + " more", base + " other words", base.upper()]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(docs).collect()}
    prints = {i: fingerprint(t) for i, t in enumerate(texts)}
    want = components(prints)
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}
    kept = sorted(r.doc_id for r in simhash.simhash_dedup(docs).collect())
    assert kept == sorted(set(want.values()))


def test_decontamination_equals_sql(spark, sf_dir, corpus):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = sorted(con.execute(decontaminate.OP1_SQL).fetchall())
    assert sorted(map(tuple, registry.op1_decontaminate(spark, sf_dir).collect())) == want


def test_decontamination_shuffled_form(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "x a b c d e f g h i j y"), (2, "a b c d"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "A b c d e f g h i j"), (8, "a b"), (None, "a b c d e"), (9, None)], "item_id long, text string")
    for limit in (100_000, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
        assert [tuple(r) for r in decontaminate.contaminated(docs, items).collect()] == [(1, 7, 6, 6, 1.0)]
    assert sorted(r.doc_id for r in decontaminate.decontaminate(docs, items).collect()) == [2, 3]


@pytest.mark.parametrize("limit", [100_000, 0])
def test_no_item_of_any_size_is_missed(spark, monkeypatch, limit):
    """Items of every size from 5 to 200 words, as parts of long and of just long enough documents, some words changed."""
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    items = {n: [rnd.choice(words) for _ in range(n)] for n in [5, 6, 7, 8, 9, 12, 15, 16, 17, 31, 32, 33, 64, 100, 200]}
    docs = {}
    for n, own in items.items():
        docs[len(docs)] = own
        docs[len(docs)] = own[:-1]
        docs[len(docs)] = [rnd.choice(words) for _ in range(300)] + own + [rnd.choice(words) for _ in range(2000)]
        docs[len(docs)] = [w if rnd.random() > 0.04 else "new" for w in own]
        docs[len(docs)] = own[n // 2:] + ["break"] + own[:n // 2 + 4]

    def shingles(ws):
        return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)}

    want = set()
    for d, text in docs.items():
        for n, own in items.items():
            every = shingles(own)
            share = len(shingles(text) & every)
            if share and share >= math.ceil(len(every) * 0.8):
                want.add((d, n, share, len(every)))
    got = decontaminate.contaminated(spark.createDataFrame([(d, " ".join(t)) for d, t in docs.items()], "doc_id long, text string"),
                                     spark.createDataFrame([(n, " ".join(t)) for n, t in items.items()], "item_id long, text string"))
    assert {tuple(r)[:4] for r in got.collect()} == want and len(want) > 30


def test_licences(spark, odd):
    texts = ["This is under the MIT license: yes", "Apache License Version 2, and cc by nc", "", None, "nothing of it"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in licences.licences(docs).collect()}
    assert (got[0].base_labels, got[0].n_base, got[0].first_word, got[0].last_word) == ("mit", 1, 2, 2)
    assert (got[1].base_labels, got[1].n_base) == ("apache-2,cc-by-nc", 2)
    assert [(got[i].n_words, got[i].n_base, got[i].first_word, got[i].base_labels) for i in (2, 3)] == [(0, 0, None, "")] * 2
    assert got[4].labels == "" and all(0 <= r.score <= 1 for r in got.values())
    assert licences.licences(odd).count() == len(ODD)


def backtrack(parts, words, at):
    """Whether a template, as a list of words, (optional parts) and counts of free words, matches at a place: by trying all ways."""
    if not parts:
        return True
    head, rest = parts[0], parts[1:]
    if isinstance(head, int):
        return any(backtrack(rest, words, at + n) for n in range(head + 1) if at + n <= len(words))
    if isinstance(head, tuple):
        return backtrack([*head, *rest], words, at) or backtrack(rest, words, at)
    return at < len(words) and words[at] == head and backtrack(rest, words, at + 1)


def written(parts):
    return " ".join(f"[[{p}]]" if isinstance(p, int) else "{{" + written(p) + "}}" if isinstance(p, tuple) else p for p in parts)


def test_automata_equal_backtracking():
    rnd = random.Random(5)
    for _ in range(150):
        parts = ["a"]
        for _ in range(rnd.randint(1, 6)):
            parts.append(rnd.choice(["a", "b", "c", rnd.randint(1, 3), ("b",), ("a", 2, "c"), ("c", ("a",), "b")]))
        parts.append(rnd.choice("abc"))
        automaton = licences.Automaton("x", written(parts))
        for _ in range(20):
            words = [rnd.choice("abc") for _ in range(rnd.randint(0, 14))]
            for at in range(len(words)):
                assert automaton.accepts([w.encode() for w in words], at) == backtrack(parts, words, at), (parts, words, at)


def filled(template, optional, free):
    """The wording of a template with its optional regions in or out and its replaceable ones filled."""
    text = re.sub(r"\[\[(\d+)\]\]", lambda m: " ".join(["Acme"] * min(free, int(m[1]))), template)
    return re.sub(r"\{\{(.*?)\}\}", r"\1" if optional else "", text, flags=re.S)


@pytest.mark.parametrize(("optional", "free"), [(True, 0), (False, 0), (True, 3), (False, 2)])
def test_whole_licences_and_a_changed_word(optional, free):
    for label, template in licences.TEMPLATES:
        scanner = licences.Scanner(templates=[(label, template)])
        text = filled(template, optional, free)
        assert label in scanner.scan("Preamble. " + text + " After it.")[5].split(","), template
        # One mandatory word changed: the template no longer accepts.
        fixed = re.sub(r"\{\{.*?\}\}|\[\[\d+\]\]", " | ", template, flags=re.S)
        longest = max(re.findall(r"[a-z]{4,}", fixed.lower()), key=len)
        assert scanner.scan(re.sub(longest, "altered", text, flags=re.I))[6] < 1.0, template


def test_base_columns_of_licences_equal_a_plain_count(spark, corpus):
    rows = [(r.doc_id, r.text) for r in corpus["documents"].collect()]
    more = ["Under the MIT License, under the mit LICENSE", "cc by nc cc-by-nc", "\u212a cc by nc", "under the mit licenses", "apache license version 2.0"]
    rows += [(-1 - i, t) for i, t in enumerate(more)]
    got = {r.doc_id: r for r in licences.licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
        at = [(k, label) for p, label in licences.PHRASES.items() for k in range(len(words)) if words[k:k + len(p.split())] == p.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (
            len(words), len(at), min((k for k, _ in at), default=None), max((k for k, _ in at), default=None), ",".join(sorted({x for _, x in at})))
        assert {x for _, x in at} <= {x for x in r.labels.split(",") if x} and 0 <= r.score <= 1


def test_marginals_equal_the_sum_over_all_label_paths():
    rnd = np.random.default_rng(4)
    for n in (1, 2, 5, 9):
        emit, trans = rnd.normal(0, 2, n), rnd.normal(0, 1, (2, 2))
        total, ones, pairs = 0.0, np.zeros(n), np.zeros((2, 2))
        cut = np.concatenate([[-np.inf], emit, [-np.inf]])          # texts stand between forced zeros
        for path in itertools.product((0, 1), repeat=n):
            full = (0, *path, 0)
            weight = math.exp(sum(e for e, s in zip(emit, path) if s) + sum(trans[a, b] for a, b in zip(full, full[1:])))
            total += weight
            ones += weight * np.array(path)
            for a, b in zip(full, full[1:]):
                pairs[a, b] += weight
        p, ahead, behind, e = toxicity.marginals(cut, trans)
        assert np.allclose(p[1:-1], ones / total) and p[0] == p[-1] == 0
        assert np.allclose(toxicity.pair_sums(ahead, behind, e, trans, np.ones(n + 2)), pairs / total)


def test_texts_in_a_row_are_tagged_as_alone():
    model = (np.random.default_rng(1).normal(0, 1, toxicity.BUCKETS), np.array([[0.2, -1.0], [-0.5, 0.8]]), -0.4, None)
    texts = ["one two three", "", "İ four " * 90, "x", "five " * 200]
    tagger = toxicity.Tagger(model)
    for alone, together in zip([tagger.marginals([t])[0] for t in texts], tagger.marginals(texts), strict=True):
        assert np.allclose(alone, together)
    spans = tagger.score(["aa bb  cc"])[1][0]
    assert all("aa bb  cc"[a:b] in ("aa", "bb", "cc") for a, b in spans)


def test_quality_verdict_held_out(spark, sf_dir):
    larger = sf_dir.replace("sf0.001", "sf0.01")
    got = registry.op10_quality(spark, larger).where("not base_failed").toPandas()
    labels = spark.read.parquet(f"{larger}/labels.parquet").selectExpr("doc_id", "quality AS truth").dropna().toPandas()
    both = got[[zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]].merge(labels, on="doc_id")
    assert len(both) > 50 and (both.kept == (both.truth == 1)).mean() > 0.9


def test_packing_and_counts_equal_the_library(odd):
    path = registry.tokenizer_path()
    library = tokenizers.Tokenizer.from_file(path)
    ids = [library.encode(t or "", add_special_tokens=False).ids for t in ODD]
    got = {r.doc_id: r for r in packing.pack(odd, path, 2).collect()}
    start = 0
    for i, own in enumerate(ids):
        own = [*own, 2]
        data = b"".join(t.to_bytes(4, "little") for t in own)
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(own), zlib.crc32(data))
        start += len(own)
    counted = {r.doc_id: r for r in tokens.token_counts(odd, path).collect()}
    for i, t in enumerate(ODD):
        assert (counted[i].n_bytes, counted[i].n_tokens, counted[i].over_limit) == (len((t or "").encode()), len(ids[i]), len(ids[i]) > 1024)


def test_quality_base_columns(spark, odd, labels):
    got = {r.doc_id: r for r in quality.quality(odd, labels).collect()}
    for i, t in enumerate(ODD):
        lines = [x for x in (t or "").split("\n")]
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        where = {}
        for k in range(len(words) - 2):
            where.setdefault(tuple(words[k:k + 3]), []).append(k)
        repeated = {k + j for v in where.values() if len(v) > 1 for k in v for j in range(3)}
        seen, dup = set(), 0
        for line in lines:
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(repeated), failed)
        assert not (failed and r.kept)


def test_toxicity_held_out(spark, sf_dir):
    # The smallest tables have too few labelled rows to learn from.
    larger = sf_dir.replace("sf0.001", "sf0.01")
    documents, labels = (spark.read.parquet(f"{larger}/{t}.parquet") for t in ("documents", "labels"))
    got = registry.op2_toxicity(spark, larger).toPandas()
    assert len(got) == documents.count() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.7)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    both = got[got.held_out].merge(labels.select("doc_id", "toxic").dropna().toPandas(), on="doc_id")
    assert (both.predicted == both.toxic).mean() > 0.9


def test_toxicity_odd_rows(odd, labels, empty):
    assert toxicity.toxicity(odd, labels).count() == len(ODD)
    assert toxicity.toxicity(empty, labels).count() == 0


def test_archives_round_trip(spark, corpus):
    forged = "WARC/1.1\r\nContent-Length: 3\r\n\r\nxyz\r\n\r\nWARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    rows = [(1, "u", "abc", "z"), (2, "u", "abc", None), (3, None, None, ""), (4, "x", "", ""), (5, "y", forged, ""), (6, "z", "é<p>", "")]
    small = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    for pages in (small, corpus["pages"].select("page_id", "url", "html")):
        payload = {r.page_id: (r.html or "").encode() for r in pages.collect()}
        newest = {}
        for i, p in payload.items():
            newest[p] = max(i, newest.get(p, i))
        want = {i: (i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if newest[p] == i else "revisit",
                    None if newest[p] == i else newest[p]) for i, p in payload.items()}
        got = warc.archive(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert {r.page_id: tuple(r) for r in got} == want
    assert warc.archive(small.limit(0)).count() == 0


def test_main_text(spark, sf_dir, corpus):
    got = {r.page_id: r for r in registry.op3_main_text(spark, sf_dir).collect()}
    right = whole = 0
    for r in corpus["pages"].collect():
        assert got[r.page_id].n_chars == len(got[r.page_id].text)
        inside = re.search(r"<article>(.*)</article>", r.html or "", re.S)
        if inside:
            blank = re.sub(r"<[^>]*>", lambda z: "" if z[0] in ("<b>", "</b>") else " ", inside[1])
            right += got[r.page_id].text == " ".join(html.unescape(blank).split())
            whole += 1
    assert right >= 0.9 * whole


def test_main_text_odd_rows(spark):
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (None, "u", "plain text only", "t"), (4, "u", "<article><p>a</p>" * 300, "t"), (4, "u", "<", "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = pagetext.main_text(pages).collect()
    assert len(got) == len(rows) and all(r.text == "" for r in got if r.page_id in (1, 2))
    assert pagetext.main_text(pages.limit(0)).count() == 0


def test_main_text_without_names(corpus):
    """Pages whose parts are all ``div`` without class words: nine of ten blocks are told as on the pages that name them."""
    pages = [r.html for r in corpus["pages"].orderBy("page_id").collect() if r.html]
    half = len(pages) // 2
    model, reader = pagetext.fit([p for p in pages[:half] if len(p) <= pagetext.LONGEST][:pagetext.PAGES]), pagetext.Reader()
    plain = [re.sub(r' class="ad"', "", re.sub(r"<(/?)(?:article|nav|footer)\b", r"<\1div", p)) for p in pages[half:]]
    truth = [[pagetext.weak_label(b.path) == 1 for b in pagetext.blocks_of(p)] for p in pages[half:]]
    cut = [pagetext.blocks_of(p) for p in plain]
    told = [(c >= 0.5) == t for k, chance in pagetext.chances(cut, model, reader) for c, t in zip(chance, truth[k], strict=True)]
    assert len(told) == sum(map(len, truth)) and sum(told) >= 0.9 * len(told)


def test_label_rule_is_no_input():
    """The same numbers go in whether or not the rule would have spoken: only hashed names, words and form."""
    named = pagetext.blocks_of('<article class="story"><p>some words, here</p></article>')
    reader = pagetext.Reader()
    arrays = reader.arrays([named])
    assert arrays[4].shape == (1, pagetext.FORM) and len(arrays[0]) == len(named[0].path)
    assert pagetext.masked(named[0].path) == ["div", "p"]


@pytest.mark.parametrize("page", ["<a " * 350_000, '<a "' * 250_000, "<!--" * 300_000, "<svg>" * 150_000, "<a '>\"" * 150_000, "<" * 1_000_000,
                                  "</p>" * 250_000, "<!" * 500_000, "<script>" * 100_000, "</script " * 100_000])
def test_pages_of_broken_tags_are_read_in_one_scan(page):
    import time

    start = time.process_time()
    pagetext.blocks_of(page)
    assert time.process_time() - start < 5


def test_tags_as_written():
    def texts(page):
        return [b.text for b in pagetext.blocks_of(page)]

    assert texts('<p title="a > b">one</p>two') == ["one", "two"]
    assert texts("<p title='a>one</p>two") == ["one", "two"]          # a quote that never closes hides nothing
    assert texts("a < b<br>c &lt; d") == ["a < b", "c < d"]
    assert texts("x<svg/>y<svg><text>no</text></svg>z") == ["x", "y", "z"]
    assert texts("x<script>var a='</p>';</script>y") == ["x", "y"]
    assert texts("x<!-- <p>no</p> -->y<!doctype html>z") == ["xyz"]
    assert texts("one<a href") == ["one<a href"]
    deep = pagetext.blocks_of("<div>" * 500 + "<nav>in</nav>" + "</div>" * 500 + "<p>out</p>")
    assert [b.text for b in deep] == ["in", "out"] and deep[0].path[-1] == "nav" and deep[1].path == ["p"]
    assert len(deep[0].path) == pagetext.OUTER + pagetext.INNER


def test_long_pages_are_read_alone():
    lengths = [3, 0, 20_000, 5, 7, 6_000] + [4] * 200
    made = list(pagetext.groups(lengths))
    assert sorted(i for g in made for i in g) == [i for i, n in enumerate(lengths) if n]
    assert all(len(g) == 1 or len(g) * max(lengths[i] for i in g) <= pagetext.CELLS for g in made) and [2] in made


def test_inputs_in_slices_equal_one_piece(monkeypatch):
    pages = [[pagetext.Block(f"w{i} and {i % 7} more words", ["div", "p"], 0.0) for i in range(n)] for n in (1, 40, 90)]
    model = pagetext.fresh()
    model["word"] += 0.1
    whole = pagetext.forward(model, pagetext.Reader().arrays(pages))[0]
    monkeypatch.setattr(pagetext, "GATHER", 7)
    monkeypatch.setattr(pagetext, "STEPS", 16)
    sliced = pagetext.forward(model, pagetext.Reader().arrays(pages))[0]
    assert abs(whole - sliced).max() < 1e-6


def test_mixture_keeps_every_document(corpus, empty):
    docs = corpus["documents"]
    made = mixing.remix(docs, max_repeat=1.5)
    assert made.columns == docs.columns
    assert made.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert mixing.mixture(empty, max_repeat=1.5).count() == 0


@pytest.mark.parametrize("how", [{"max_repeat": 1.5}, {"max_repeat": 3.0}, {"target_entropy": 1.2}, {"target_entropy": 0.9, "budget": 700.0}])
def test_mixture_equals_a_plain_plan(spark, how):
    rnd = random.Random(8)
    texts = [(i, rnd.choice(["hot"] * 6 + ["b", "b", "c", None]), "w " * rnd.randint(0, 9)) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, source string, text string")
    totals = {}
    for _, source, text in texts:
        totals[source] = totals.get(source, 0) + len(text.split())
    every, budget = sum(totals.values()), how.get("budget")
    shares = {s: n / every for s, n in totals.items()}

    def weights(x):
        powers = {s: v ** x for s, v in shares.items()}
        return {s: p / sum(powers.values()) for s, p in powers.items()}

    def good(x):
        w = weights(x)
        if "max_repeat" in how:
            ratios = [w[s] / shares[s] for s in w]
            return max(ratios) / min(ratios) <= how["max_repeat"]
        return -sum(v * math.log(v) for v in w.values()) >= how["target_entropy"]

    grid = [i / 20_000 for i in range(20_001)]
    exponent = min(x for x in grid if good(x)) if "max_repeat" in how else max([x for x in grid if good(x)], default=0.0)
    w = weights(exponent)
    budget = budget or max(totals[s] / w[s] for s in w)
    got = mixing.mixture(docs, **how).toPandas()
    longest = 9
    for s, n in totals.items():
        taken = got[got.source.isna()] if s is None else got[got.source == s]
        # Whole documents: short of the budget by less than one document of the last block.
        assert w[s] * budget - longest - 0.002 * budget <= taken.n_tokens.sum() <= w[s] * budget * 1.002, (s, n)
        times = taken[taken.n_tokens > 0].groupby("doc_id").size()
        assert times.empty or times.max() - times.reindex([i for i, o, t in texts if o == s and t], fill_value=0).min() <= 1
    assert all(len(own) == own.doc_id.nunique() for _, own in got.fillna({"source": "-"}).groupby(["source", "epoch"]))


def test_empty_tables(spark, empty, labels, corpus):
    path = registry.tokenizer_path()
    made = (simhash.simhash_components(empty), simhash.simhash_dedup(empty), decontaminate.contaminated(empty, corpus["benchmark"]),
            licences.licences(empty), packing.pack(empty, path, 2), tokens.token_counts(empty, path), quality.quality(empty, labels),
            toxicity.drop_toxic(empty, empty, labels), decontaminate.contaminated(corpus["documents"], corpus["benchmark"].limit(0)))
    assert [m.count() for m in made] == [0] * len(made)
