"""Chunked operators equal their one-window form, for any chunk size and any row order."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.operators import clean, layers, segment, sequence
from fathomline.plans import jobs


def numbers(n, seed=1):
    rnd = random.Random(seed)
    return [(k, i, rnd.choice([None, float(rnd.randint(0, 9))])) for k in "ab" for i in range(n) if rnd.random() < 0.6]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("size", [1, 7, 64])
def test_chunks_do_not_change_results(spark, size):
    df = spark.createDataFrame(numbers(60), "k string, i bigint, v double").withColumn("one", F.lit(1).cast("bigint"))
    for later in (False, True):
        a = sequence.last_known(df, ["k"], "i", "v", "x", size, later).select("k", "i", "x")
        b = sequence.last_known(df, ["k"], "i", "v", "x", None, later).select("k", "i", "x")
        assert rows(a) == rows(b)
    assert rows(sequence.next_row(df, ["k"], "i", ["v"], size).select("k", "i", "next_i", "next_v")) == rows(
        sequence.next_row(df, ["k"], "i", ["v"], None).select("k", "i", "next_i", "next_v"))
    assert rows(sequence.running_sum(df, ["k"], "i", "one", "s", size).select("k", "i", "s")) == rows(
        sequence.running_sum(df, ["k"], "i", "one", "s", None).select("k", "i", "s"))


def test_number_rows(spark):
    data = [("hot", i * 7 % 501) for i in range(501)] + [("cold", 3), ("cold", 1), (None, 5)]
    df = spark.createDataFrame(data, "k string, v int")
    got = {(r.k, r.v): r.n for r in sequence.number_rows(df, ["k"], ["v"], "n").collect()}
    assert got == {**{("hot", i): i for i in range(501)}, ("cold", 1): 0, ("cold", 3): 1, (None, 5): 0}


@pytest.mark.parametrize("size", [None, 10])
def test_exact_median(spark, size):
    data = [("a", 1.0, 5.0), ("a", 4.0, None), ("a", 2.0, 7.0), ("a", 2.0, None), ("b", None, 3.0), ("b", 9.0, 3.0)]
    df = spark.createDataFrame(data, "k string, x double, y double")
    got = {r.k: (r.x, r.y) for r in sequence.exact_median(df, ["k"], ["x", "y"], size).collect()}
    assert got == {"a": (2.0, 6.0), "b": (9.0, 3.0)}


def test_chunk_size_is_measured(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)], "k string")
    assert sequence.chunk_size(df, ["k"], limit=5) is None
    assert sequence.chunk_size(df, ["k"], limit=4) == sequence.CHUNK


@pytest.mark.parametrize("size", [50, 300])
def test_hot_cast_path_gives_the_same_casts(spark, sf_dir, size):
    from fathomline import fixtures
    scans = fixtures.level1(spark, sf_dir).where("cast_no < 4")
    columns = ["cast_id", "scan", "is_downcast", *[F.round(c, 9).alias(c) for c in (
        "pressure_dbar", "oxygen_saturation_percent", "mld_temp", "mld_dens", "N2")]]
    whole = jobs.process_casts(scans, size=None).select(*columns)
    chunked = jobs.process_casts(scans.repartition(5), size=size).select(*columns)
    assert rows(whole) == rows(chunked)


def test_nearest_ties_and_collisions(spark):
    points = spark.createDataFrame([("c", 0, 1.0), ("c", 1, 3.0), ("c", 2, 1.0), ("c", 3, 9.0)],
                                   "cast_id string, scan bigint, pressure_dbar double")
    pairs = spark.createDataFrame([("c", 0, 2.0, 0.1), ("c", 1, 0.5, 0.2), ("c", 2, 8.0, 0.3)],
                                  "cast_id string, mid_no bigint, p_mid double, N2 double")
    for size in (None, 10):
        got = layers.n2_nearest(points, pairs, size=size)
        # 2.0 lies between scans 0 and 1: the smaller scan; then 0.5 lands on scan 0 as well and stays.
        assert rows(got) == [("c", 0, 0.2), ("c", 3, 0.3)]


def test_mixed_layer_stays_missing(spark):
    df = spark.createDataFrame([("a", 0, 0.5, 10.0, 1000.0), ("a", 1, 2.0, 10.0, 1000.0), ("a", 2, 3.0, 10.1, 1000.1),
                                ("b", 0, 0.2, 5.0, 1000.0)],
                               "cast_id string, scan bigint, pressure_dbar double, temperature_C double, "
                               "density_kg_m3 double")
    got = {r.cast_id: (r.mld_temp, r.mld_dens) for r in layers.mixed_layer(df).collect()}
    assert got == {"a": (None, 3.0)}


def test_water_rows_at_threshold_are_in_neither(spark):
    df = spark.createDataFrame([("rbr", 0.15), ("rbr", 0.1), ("rbr", 0.2), ("EXO", 0.2), ("rbr", None)],
                               "ctd_type string, conductivity_mS_per_m double")
    assert [r.medium for r in clean.air_water_split(df).collect()] == [None, "air", "water", "air", None]


# ---- segmentation ---------------------------------------------------------------------------------------------------

def brute_minima(s):
    """Positions of strict minima and flat valleys' midpoints."""
    out, i = [], 1
    while i < len(s) - 1:
        if s[i - 1] > s[i]:
            j = i
            while j < len(s) - 1 and s[j + 1] == s[i]:
                j += 1
            if j < len(s) - 1 and s[j + 1] > s[i]:
                out.append((i + j) // 2)
            i = j + 1
        else:
            i += 1
    return out


def brute_thin(s, minima, distance):
    kept = []
    for m in sorted(minima, key=lambda m: (s[m], -m)):
        if all(abs(m - k) >= distance for k in kept):
            kept.append(m)
    return sorted(kept)


def brute_prominent(s, m, depth):
    def side(walk):
        top = s[m]
        for i in walk:
            if s[i] < s[m]:
                break
            top = max(top, s[i])
        return top
    return min(side(range(m, -1, -1)), side(range(m, len(s)))) >= s[m] + depth


def series(n, seed):
    rnd = random.Random(seed)
    level, out = 20.0, []
    for _ in range(n):
        level = max(0.0, level + rnd.choice([-3.0, -1.0, 0.0, 0.0, 1.0, 3.0]))
        out.append(level)
    return out


@pytest.mark.parametrize("size", [None, 16, 40])
@pytest.mark.parametrize("seed", [1, 2])
def test_minima_rules_against_brute_force(spark, size, seed):
    data = {f"c{k}": series(400, seed * 10 + k) for k in range(3)}
    flat = [(c, i, v, s[i - 1] if i else None, s[i + 1] if i + 1 < len(s) else None)
            for c, s in data.items() for i, v in enumerate(s)]
    smoothed = spark.createDataFrame(flat, "cast_id string, scan bigint, smoothed double, before double, after double")
    turns = segment.turning_points(smoothed)
    minima = segment.pressure_minima(turns, size=size)
    want = {c: brute_minima(s) for c, s in data.items()}
    assert sorted((r.cast_id, r.scan) for r in minima.collect()) == [(c, m) for c in want for m in want[c]]
    for distance, depth in ((8, 6.0), (25, 10.0)):
        reach = None if size is None or size < 4 * distance else size
        thin = segment.thin_minima(minima, distance, size=reach)
        kept = {c: brute_thin(s, want[c], distance) for c, s in data.items()}
        assert sorted((r.cast_id, r.scan) for r in thin.collect()) == [(c, m) for c in kept for m in kept[c]]
        found = segment.prominent_minima(turns, thin, depth, size=size)
        good = [(c, m) for c in kept for m in kept[c] if brute_prominent(data[c], m, depth)]
        assert sorted((r.cast_id, r.scan) for r in found.collect()) == good


@pytest.mark.parametrize("size", [None, 64])
def test_smoothing_edges(spark, size):
    # A quadratic is reproduced exactly, edges included.
    data = [("q", i, 0.5 * i * i - 3.0 * i + 2.0) for i in range(150)]
    df = spark.createDataFrame(data, "cast_id string, scan bigint, pressure_dbar double")
    got = {r.scan: r for r in segment.smooth_pressure(df, size=size).collect()}
    assert sorted(got) == list(range(150))
    for i, (_, _, v) in enumerate(data):
        assert got[i].smoothed == pytest.approx(v, abs=1e-8)
        assert (got[i].before is None) == (i == 0) and (got[i].after is None) == (i == 149)
        if i:
            assert got[i].before == pytest.approx(got[i - 1].smoothed, abs=1e-9)


def test_short_cast_is_one_segment(spark):
    df = spark.createDataFrame([("s", i, float(i)) for i in range(12)], "cast_id string, scan bigint, pressure_dbar double")
    bounds = segment.segment_bounds(df)
    assert [tuple(r) for r in segment.segments(df, bounds).collect()] == [("s", 0, 0, 11)]


@pytest.mark.parametrize("size", [None, 400])
def test_segments_cover_all_scans_and_share_one(spark, sf_dir, size):
    from fathomline import fixtures
    scans = fixtures.level1(spark, sf_dir).repartition(3)
    parts = segment.segments(scans, segment.segment_bounds(scans, size=size), size=size)
    spans = {}
    for r in parts.orderBy("cast_id", "segment").collect():
        spans.setdefault(r.cast_id, []).append((r.start, r.end))
    ends = {r.cast_id: r.m for r in scans.groupBy("cast_id").agg(F.max("scan").alias("m")).collect()}
    for cast, s in spans.items():
        assert s[0][0] == 0 and s[-1][1] == ends[cast]
        assert all(a[1] == b[0] for a, b in zip(s, s[1:]))


@pytest.mark.parametrize("open_size", [400, 1 << 22])
def test_thinning_of_a_long_run(spark, open_size):
    # Every minimum is nearer than the distance to the next and shallower than the one before it, with a few equal ones.
    n = 6000 if open_size > 400 else 700
    depth = [float(-(n - i) // 2) for i in range(n)]
    rows = spark.createDataFrame([("c", 2 * i, d) for i, d in enumerate(depth)], "cast_id string, scan bigint, smoothed double")
    kept, want = [], []
    for i in sorted(range(n), key=lambda i: (depth[i], -i)):
        if all(abs(i - k) * 2 >= 50 for k in kept[-60:]):
            kept.append(i)
    got = segment.thin_minima(rows, 50, size=1024, open_size=open_size)
    assert sorted(r.scan for r in got.collect()) == sorted(2 * i for i in kept)
    assert sorted(r.scan for r in segment.thin_minima(rows, 50, size=None).collect()) == sorted(2 * i for i in kept)


def test_rises_equal_a_plain_walk():
    draw = np.random.default_rng(4)
    for n in (1, 2, 3, 17, 64, 200):
        s = draw.integers(0, 12, n).astype(float)
        want = []
        for i in range(n):
            top, found = s[i], -1
            for j in range(i - 1, -1, -1):
                if s[j] < s[i]:
                    found = 0
                    break
                top = max(top, s[j])
            want.append(1 if top >= s[i] + 4 else found)
        assert segment._rise_before(s, 4.0).tolist() == want
