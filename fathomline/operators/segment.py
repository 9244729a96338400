"""Splitting a record into casts at the significant minima of its smoothed pressure.

Everything row-sized runs in ``(cast, chunk)`` groups with a fixed reach over the border. Only turning points (a small
part of the scans) go further, and of those only the few a chunk cannot settle by itself meet in a per-cast step.
``scan`` must be dense from 0, as the ingest jobs number it.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from fathomline.functions.text import stem
from fathomline.operators.sequence import CHUNK, chunk_of, next_row, running_sum, with_halo
from fathomline.storage import save_stage

# A quadratic fitted to 21 samples, and the minima rules the segmentation uses by default.
HALF = 10
SAMPLES = 2 * HALF + 1
PROMINENCE = 10.0
DISTANCE = 50
# Rounds in which minima that beat all neighbours within the distance are settled side by side.
ROUNDS = 2
# Length of the scan blocks in which scans meet the segments that cover them.
BLOCK = 1024
# Scans of a chunk in which minima left open are settled; of these at most every other is a minimum.
OPEN_CHUNK = 1 << 22
GONE, KEPT, OPEN = 0, 1, 2


def _fit(at, m0, m1, m2):
    """Fitted value ``at`` samples from the centre; m0, m1, m2 are the moments of the 21 samples."""
    curve = at * at - 110.0 / 3.0
    return m0 / 21.0 + at * m1 / 770.0 + curve * m2 * (3.0 / 67298.0)


def smooth_pressure(scans, cast="cast_id", order="scan", value="pressure_dbar", size=CHUNK):
    """``(cast, scan, smoothed, before, after)``: the quadratic fit, and the fitted neighbours on each side.

    The first and the last ten rows come from the fit around the first and last full centre, so those two centres emit
    eleven rows each. Casts shorter than the fit give no rows.
    """
    rows = with_halo(scans.select(cast, order, value), order, SAMPLES + 1, size)
    near = Window.partitionBy(cast, "_chunk").orderBy(order)

    def at(k):
        return F.col(value) if k == 0 else F.lag(value, -k).over(near)

    rows = rows.withColumn("_w", F.array(*[at(k) for k in range(-HALF, HALF + 1)]))
    rows = rows.withColumns({
        "_first": F.lag(order, HALF + 1).over(near).isNull() & F.lag(order, HALF).over(near).isNotNull(),
        "_last": F.lead(order, HALF + 1).over(near).isNull() & F.lead(order, HALF).over(near).isNotNull(),
    })
    sample = [F.col("_w")[k + HALF] for k in range(-HALF, HALF + 1)]
    rows = rows.withColumns({
        "_m0": sum(sample[1:], sample[0]),
        "_m1": sum((sample[k + HALF] * float(k) for k in range(-HALF + 1, HALF + 1)), sample[0] * float(-HALF)),
        "_m2": sum((sample[k + HALF] * (k * k - 110.0 / 3.0) for k in range(-HALF + 1, HALF + 1)),
                   sample[0] * (HALF * HALF - 110.0 / 3.0)),
    }).drop("_w")
    m = [F.col("_m0"), F.col("_m1"), F.col("_m2")]
    rows = rows.withColumn("_s", _fit(F.lit(0.0), *m))
    rows = rows.withColumns({"_sp": F.lag("_s").over(near), "_sn": F.lead("_s").over(near)})
    # In a chunk's halo the first/last marks are not reliable; core rows have their full surroundings.
    rows = rows.where(F.col("_core") & F.col("_m0").isNotNull())
    reach = F.sequence(F.when(F.col("_first"), -HALF).otherwise(0), F.when(F.col("_last"), HALF).otherwise(0))
    rows = rows.withColumn("_k", F.explode(reach))
    k = F.col("_k").cast("double")
    start, end = F.col("_first") & (F.col("_k") == -HALF), F.col("_last") & (F.col("_k") == HALF)
    return rows.select(
        cast, (F.col(order) + F.col("_k")).alias(order),
        F.when(F.col("_k") == 0, F.col("_s")).otherwise(_fit(k, *m)).alias("smoothed"),
        F.when(start, None).when((F.col("_k") > 0) | F.col("_first"), _fit(k - 1.0, *m))
        .otherwise(F.col("_sp")).alias("before"),
        F.when(end, None).when((F.col("_k") < 0) | F.col("_last"), _fit(k + 1.0, *m))
        .otherwise(F.col("_sn")).alias("after"))


def turning_points(smoothed, order="scan"):
    """Rows where the direction changes, plateau edges and the two ends: all the later steps need.

    ``step_in`` and ``step_out`` are the signs of the steps before and after the row (NULL at an end).
    """
    turns = smoothed.withColumns({
        "step_in": F.signum(F.col("smoothed") - F.col("before")),
        "step_out": F.signum(F.col("after") - F.col("smoothed")),
    })
    same_way = F.col("step_in").isNotNull() & F.col("step_out").isNotNull() & (F.col("step_in") == F.col("step_out"))
    return turns.where(~same_way).drop("before", "after")


def stage_turns(scans, cast="cast_id", order="scan", value="pressure_dbar", size=CHUNK):
    """Turning points as a stage table: several steps read them, and they are few next to the scans."""
    return save_stage(turning_points(smooth_pressure(scans, cast, order, value, size), order), "turns")


def pressure_minima(turns, cast="cast_id", order="scan", size=CHUNK):
    """Strict minima, and the midpoint of a flat valley; ends never count. ``(cast, scan, smoothed)``."""
    strict = turns.where("step_in = -1 AND step_out = 1").select(cast, order, "smoothed")
    edges = turns.where("(step_in = 0 AND step_out <> 0) OR (step_out = 0 AND coalesce(step_in, 1) <> 0)")
    edges = next_row(edges.select(cast, order, "smoothed", "step_in", "step_out"), [cast], order,
                     ["step_in", "step_out"], size)
    flat = edges.where("step_in = -1 AND step_out = 0 AND next_step_in = 0 AND next_step_out = 1")
    middle = F.floor((F.col(order) + F.col(f"next_{order}")) / 2).cast("bigint")
    return strict.unionByName(flat.select(cast, middle.alias(order), "smoothed"))


def thin_minima(minima, distance=DISTANCE, cast="cast_id", order="scan", size=CHUNK, rounds=ROUNDS, open_size=OPEN_CHUNK):
    """Deepest first, drop minima nearer than ``distance`` to one already kept (equal depth: the later one first).

    A minimum that beats everything within the distance is certainly kept and its neighbours certainly go; this is
    settled for all of them at once, ``rounds`` times. What is left open is settled in chunks of ``open_size`` scans, each
    by itself as far as its minima do not hang on open ones beyond its border; with the borders moved by half a chunk this
    is repeated until nothing is open, so a run of any length is worked through chunk by chunk, never held whole.
    """
    open_rows = with_halo(minima, order, 2 * distance * rounds, size).withColumns(
        {"_open": F.lit(True), "_kept": F.lit(False)})
    near = Window.partitionBy(cast, "_chunk").orderBy(order).rangeBetween(-(distance - 1), distance - 1)
    rank = F.struct(F.col("smoothed").alias("s"), (-F.col(order)).alias("o"))
    for _ in range(rounds):
        best = F.min(F.when(F.col("_open"), rank)).over(near)
        open_rows = open_rows.withColumn("_wins", F.col("_open") & (best == rank))
        open_rows = open_rows.withColumn("_beaten", F.max("_wins").over(near))
        open_rows = open_rows.withColumns({
            "_kept": F.col("_kept") | F.col("_wins"),
            "_open": F.col("_open") & ~F.col("_beaten"),
        })
    core = save_stage(open_rows.where("_core").select(cast, order, "smoothed", "_kept", "_open"), "minima")
    kept = core.where("_kept").select(cast, order, "smoothed")
    rows = core.where("_open").select(cast, order, "smoothed", F.lit(OPEN).cast("tinyint").alias("state"))
    kind = rows.schema[cast].dataType.simpleString()
    schema = f"{cast} {kind}, {order} bigint, smoothed double, state tinyint"

    def settle(group):
        state = _settled(group[order].to_numpy(), group["smoothed"].to_numpy(), group["state"].to_numpy(),
                         group["_core"].to_numpy(), distance)
        keep = group["_core"].to_numpy() & (state != GONE) & (group["state"].to_numpy() != KEPT)
        return group.loc[keep, [cast, order, "smoothed"]].assign(state=state[keep])

    if size is None:
        # Every cast is one chunk: nothing can stay open.
        placed = rows.withColumn("_core", F.lit(True))
        return kept.unionByName(_by_group(placed, [cast], order, settle, schema).drop("state"))
    turn = 0
    while not rows.where(F.col("state") == OPEN).isEmpty():
        shift = (turn % 2) * (open_size // 2)
        placed = with_halo(rows.withColumn("_place", F.col(order) + shift), "_place", distance, open_size)
        after = save_stage(_by_group(placed, [cast, "_chunk"], order, settle, schema), "thinned")
        kept = kept.unionByName(after.where(F.col("state") == KEPT).drop("state"))
        # Minima kept just now still clear their surroundings beyond the border, in the next turn.
        rows, turn = after, turn + 1
    return kept


def _settled(at, depth, state, core, distance):
    """States after the greedy choice among one chunk's minima, in order of place. Minima of the halo whose own surroundings
    are not all here stay open, and so does whatever hangs on an open one that beats it."""
    n = len(at)
    low, high = np.searchsorted(at, at - distance, "right"), np.searchsorted(at, at + distance, "left")
    gone, waits = np.zeros(n, bool), ~core
    for i in np.flatnonzero(state == KEPT).tolist():
        gone[low[i]:high[i]] = True
    out = np.full(n, GONE, np.int8)
    out[state == KEPT] = KEPT
    for i in np.lexsort((-at, depth)).tolist():
        if gone[i]:
            continue
        if waits[i]:
            out[i] = OPEN
            waits[low[i]:high[i]] = True
        else:
            out[i] = KEPT
            gone[low[i]:high[i]] = True
    return out


def _ranges(s, pick):
    """Sparse table: entry k holds ``pick`` of every 2^k samples in a row, by the first one's place."""
    table, width = [s], 1
    while 2 * width <= len(s):
        table.append(pick(table[-1][:-width], table[-1][width:]))
        width *= 2
    return table


def _rise_before(s, depth):
    """For each sample: does the series, walked back from it, rise by ``depth`` before it sinks below it?

    1 yes, 0 no, -1 undecided when the walk reaches the start. All samples walk at once, in steps of falling powers of two:
    a step is taken where the least value of its range is not below the sample, and its greatest value is noted.
    """
    lows, highs = _ranges(s, np.minimum), _ranges(s, np.maximum)
    at, top = np.arange(len(s)), s.copy()
    for k in reversed(range(len(lows))):
        start = at - (1 << k)
        there = np.maximum(start, 0)
        there = np.minimum(there, len(lows[k]) - 1)
        go = (start >= 0) & (lows[k][there] >= s)
        top = np.where(go, np.maximum(top, highs[k][there]), top)
        at = np.where(go, start, at)
    return np.where(top >= s + depth, 1, np.where(at > 0, 0, -1)).astype(np.int8)


def _staircase(s, depth):
    """Marks the record lows and highs seen from the start, up to where they span ``depth``."""
    low, high = np.minimum.accumulate(s), np.maximum.accumulate(s)
    marks = np.ones(len(s), dtype=bool)
    marks[1:] = (s[1:] < low[:-1]) | (s[1:] > high[:-1])
    wide = np.flatnonzero(high - low >= depth)
    if len(wide):
        marks[wide[0] + 1:] = False
    return marks


def _sides(s, depth):
    return _rise_before(s, depth), _rise_before(s[::-1], depth)[::-1]


def prominent_minima(turns, minima, prominence=PROMINENCE, cast="cast_id", order="scan", size=CHUNK):
    """Minima the series rises from by ``prominence`` on both sides before it sinks below them.

    Each chunk settles what it can. What it cannot is passed on with the chunk's two staircases of record values, the
    only samples a walk from outside can stop at, and is settled per cast on those few rows.
    """
    marked = turns.select(cast, order, "smoothed", F.lit(False).alias("candidate")).unionByName(
        minima.select(cast, order, "smoothed", F.lit(True).alias("candidate")))
    # A flat valley's midpoint is no turning row itself, so candidates are added, once per position.
    marked = marked.groupBy(cast, order).agg(
        F.max("smoothed").alias("smoothed"), F.max("candidate").alias("candidate"))
    marked = marked.withColumn("_chunk", chunk_of(order, size))
    kind = marked.schema[cast].dataType.simpleString()
    whole = size is None

    def in_chunk(rows):
        s = rows["smoothed"].to_numpy()
        before, after = _sides(s, prominence)
        if whole:
            # The walk ended at the end of the series without a rise.
            before, after = np.maximum(before, 0), np.maximum(after, 0)
        candidate = rows["candidate"].to_numpy() & (before != 0) & (after != 0)
        evidence = candidate & ((before < 0) | (after < 0))
        if not whole:
            evidence |= _staircase(s, prominence) | _staircase(s[::-1], prominence)[::-1]
        return rows[[cast, order, "smoothed"]].assign(
            before=before, after=after, candidate=candidate, evidence=evidence)[candidate | evidence]

    settled = _by_group(marked, [cast, "_chunk"], order, in_chunk,
                        f"{cast} {kind}, {order} bigint, smoothed double, before tinyint, after tinyint, "
                        "candidate boolean, evidence boolean")
    if whole:
        return settled.select(cast, order, "smoothed")
    settled = save_stage(settled, "settled")

    def across(rows):
        before, after = _sides(rows["smoothed"].to_numpy(), prominence)
        left, right = rows["before"].to_numpy(), rows["after"].to_numpy()
        good = (np.where(left < 0, before, left) == 1) & (np.where(right < 0, after, right) == 1)
        return rows.loc[rows["candidate"].to_numpy() & good, [cast, order, "smoothed"]]

    done = settled.where("candidate AND before = 1 AND after = 1").select(cast, order, "smoothed")
    waiting = settled.where("evidence").withColumn(
        "candidate", F.col("candidate") & ((F.col("before") < 0) | (F.col("after") < 0)))
    open_casts = waiting.where("candidate").select(cast).distinct()
    joined = _by_group(waiting.join(open_casts, cast, "left_semi"), [cast], order, across,
                       f"{cast} {kind}, {order} bigint, smoothed double")
    return done.unionByName(joined)


def _by_group(df, keys, order, work, schema):
    """``work`` on each group of rows in ``order``; many small groups share one Arrow batch, unlike applyInPandas."""
    def run(batches):
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            starts = np.flatnonzero((rows[keys] != rows[keys].shift()).any(axis=1).to_numpy())
            for a, b in zip(starts[:-1], starts[1:]):
                yield work(rows.iloc[a:b])
            rest = rows.iloc[starts[-1]:] if len(starts) else None
        if rest is not None and len(rest):
            yield work(rest)

    return df.repartition(*keys).sortWithinPartitions(*keys, order).mapInPandas(run, schema)


def segment_bounds(scans, cast="cast_id", order="scan", value="pressure_dbar", prominence=PROMINENCE,
                   distance=DISTANCE, size=CHUNK):
    """Interior bounds: thinned minima that are prominent as well. ``(cast, scan)``."""
    turns = stage_turns(scans, cast, order, value, size)
    minima = pressure_minima(turns, cast, order, size)
    kept = thin_minima(minima, distance, cast, order, size)
    return prominent_minima(turns, kept, prominence, cast, order, size).select(cast, order)


def segments(scans, bounds, cast="cast_id", order="scan", size=CHUNK):
    """``(cast, segment, start, end)`` from 0, the bounds and the last scan; neighbours share their bound."""
    ends = scans.groupBy(cast).agg(F.max(order).alias("_last"))
    edges = bounds.select(cast, F.col(order).alias("start")).unionByName(
        ends.select(cast, F.lit(0).cast("bigint").alias("start")))
    edges = next_row(edges, [cast], "start", [], size)
    edges = edges.join(ends, cast).select(
        cast, "start", F.coalesce("next_start", "_last").alias("end"))
    return number_segments(edges, cast, size)


def number_segments(edges, cast="cast_id", size=CHUNK):
    """Number the segments of a cast from 0 in scan order."""
    one = edges.withColumn("_one", F.lit(1).cast("bigint"))
    return running_sum(one, [cast], "start", "_one", "segment", size).select(
        cast, (F.col("segment") - 1).cast("bigint").alias("segment"), "start", "end")


def segment_profiles(scans, parts, cast="cast_id", order="scan"):
    """Scans with their segment; a shared bound appears in both. Scans meet segments inside blocks of the scan axis."""
    block = F.explode(F.sequence(F.expr(f"start div {BLOCK}"), F.expr(f"end div {BLOCK}")))
    covered = parts.withColumn("_block", block)
    rows = scans.withColumn("_block", F.expr(f"{order} div {BLOCK}"))
    return rows.join(covered, [cast, "_block"]).where(F.col(order).between(F.col("start"), F.col("end"))).drop("_block")


def profile_names(scans, parts, cast="cast_id", order="scan", source="source_file"):
    """``<first timestamp or file stem>_<number>.csv`` for each segment."""
    first = parts.join(scans.select(cast, F.col(order).alias("start"), source, "timestamp"), [cast, "start"])
    base = F.coalesce(F.date_format("timestamp", "yyyyMMdd_HHmmss"), stem(F.col(source)))
    return first.select(cast, "segment", "start", "end", F.concat(
        base, F.lit("_"), (F.col("segment") + 1).cast("string"), F.lit(".csv")).alias("profile_name"))
