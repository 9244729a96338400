"""SimHash near-duplicates through a hierarchical index in Gray order.

Fingerprints within the limit of ``k`` differing bits agree wholly on one of ``k + 1`` parts of their bits. The upper nodes of
the index are these shared masked patterns: each fingerprint enters one node for each part, ``(mask, pattern)``. A node
that holds more than ``GROUP`` fingerprints is divided again by the parts of its remaining bits, until all nodes are small; a
node with few remaining bits cannot be large. So every fingerprint moves a fixed number of times, however many there are.

Inside a node fingerprints are sorted by the Gray rank of the bits that are not shared. Neighbours differ in few bits, so a
run of them has many bits in common: a lower node keeps that mask and pattern, and two lower nodes whose common bits
already differ in more than the limit are dropped as a whole. Differences add up from level to level, since a lower node
knows all bits of the upper one and some more.

On Spark: nodes are counted with map-side aggregates, large ones go to the next level, small ones are shuffled by node and
searched in tasks, many at once. A task returns a spanning forest of the links of a node, not the links, so a large group of
near copies stays linear. Components of the forests are found by contraction in Spark.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import drop_stage, map_texts, staged

#: Fingerprints that an upper node holds at most when it is searched.
GROUP = 16384
#: Greatest bit distance: a node with as many remaining bits holds fewer than ``GROUP``, so dividing always ends.
MOST_BITS = 12
#: Fingerprints in the nodes of the levels below, from the top.
LEVELS = (4096, 512, 64)
#: Pairs of leaves compared at once, and fingerprints of whole small nodes worked on at once.
LEAF_PAIRS, AT_ONCE = 128, 65536


# -- fingerprints ---------------------------------------------------------------------------------------------------

def fingerprint(text: str, shingle: int, spread: np.ndarray) -> int:
    """64-bit SimHash of whole text: shingles of words, repeats included, hashed by XXH64 with seed 42.

    ``spread[b]`` holds the bits of byte b as eight counters of one byte, so 255 hashes are summed at once.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    last = min(shingle, len(words)) - 1
    cuts = zip(starts[:len(words) - last].tolist(), ends[last:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in cuts], np.uint64)
    octets, counts = hashes.view(np.uint8).reshape(-1, 8), np.zeros(64, np.int64)
    for i in range(0, len(octets), 255):
        counts += spread[octets[i:i + 255]].sum(axis=0, dtype=np.uint64).view(np.uint8)
    set_bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(set_bits.view(np.int64)[0])


def counters() -> np.ndarray:
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(bits).view(np.uint64)[:, 0]


def with_fingerprint(docs: DataFrame, keep: list[str], text: str, shingle: int) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint as a signed 64-bit number."""
    def work(texts, spread):
        return {"fp": np.array([fingerprint(t, shingle, spread) for t in texts], np.int64)}

    return map_texts(docs, keep, text, work, "fp long", counters)


# -- the index ------------------------------------------------------------------------------------------------------

def gray_rank(fp):
    """Place of a 64-bit pattern in the reflected Gray code, with the top bit turned so that signed order is right."""
    for step in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, step))
    return fp.bitwiseXOR(F.lit(-2 ** 63))


def nodes(fps: np.ndarray, size: int):
    """Mask of the bits that all fingerprints of a node share, and their pattern, for runs of ``size``."""
    at = np.arange(0, len(fps), size)
    same = np.bitwise_and.reduceat(fps, at) | np.bitwise_and.reduceat(~fps, at)
    return same, fps[at] & same


def parts_of(mask: int, parts: int) -> list[int]:
    """Masks of the remaining bits, cut into parts of about equal size, each joined with the given mask."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in free[i:j]) for i, j in zip(cuts, cuts[1:])]


def signed(mask: int) -> int:
    return mask - 2 ** 64 if mask >= 2 ** 63 else mask


class Forest:
    """Union-find on arrays: labels are the smallest member of a tree."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            a, b = self.label[a], self.label[b]
            apart = a != b
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(self.label, up := self.label[self.label]):
                self.label = up


def search(fps: np.ndarray, limit: int, forest: Forest, first: int = 0) -> None:
    """Link what is within ``limit`` bits among fingerprints in Gray order, numbered from ``first`` in the forest."""
    # One root, whose shared bits are unknown so far: no difference yet.
    pair_a, pair_b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    seen, known, above = np.zeros(1, np.int64), np.zeros(1, np.uint64), None
    for size in LEVELS:
        mask, form = nodes(fps, size)
        fan = len(mask) if above is None else above // size
        spot = np.arange(fan)
        a = (pair_a[:, None, None] * fan + spot[:, None]) + np.zeros((1, 1, fan), np.int64)
        b = (pair_b[:, None, None] * fan + spot) + np.zeros((1, fan, 1), np.int64)
        up = np.broadcast_to(np.arange(len(pair_a))[:, None, None], a.shape).ravel()
        a, b = a.ravel(), b.ravel()
        real = (a <= b) & (b < len(mask))
        a, b, up = a[real], b[real], up[real]
        common = mask[a] & mask[b]
        # Only the bits that the upper pair did not share are new; their differences are added.
        total = seen[up] + np.bitwise_count((form[a] ^ form[b]) & common & ~known[up])
        near = total <= limit
        pair_a, pair_b, seen, known, above = a[near], b[near], total[near], common[near], size
    leaf = LEVELS[-1]
    spot = np.arange(leaf)
    for i in range(0, len(pair_a), LEAF_PAIRS):
        at_a = pair_a[i:i + LEAF_PAIRS, None] * leaf + spot
        at_b = pair_b[i:i + LEAF_PAIRS, None] * leaf + spot
        fp_a, fp_b = fps[np.minimum(at_a, len(fps) - 1)], fps[np.minimum(at_b, len(fps) - 1)]
        which, x, y = np.nonzero(np.bitwise_count(fp_a[:, :, None] ^ fp_b[:, None, :]) <= limit)
        x, y = at_a[which, x], at_b[which, y]
        real = (x < y) & (y < len(fps))
        forest.link(x[real] + first, y[real] + first)


def forest_edges(fps: np.ndarray, starts: np.ndarray, limit: int):
    """Edges ``(u, v)`` of the forests of whole nodes that lie one after another, each sorted by Gray rank.

    Nodes of at most a leaf's size are compared side by side, row by row at growing distance; larger ones are searched one by one.
    """
    sizes, forest = np.diff(np.r_[starts, len(fps)]), Forest(len(fps))
    leaf = LEVELS[-1]
    left = np.where(sizes <= leaf, sizes, 0).repeat(sizes) - (np.arange(len(fps)) - starts.repeat(sizes))  # rows of the node from here on
    one, other = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    rows = np.flatnonzero(left > 1)
    for step in range(1, leaf):
        rows = rows[left[rows] > step]
        if not len(rows):
            break
        near = rows[np.bitwise_count(fps[rows] ^ fps[rows + step]) <= limit]
        one.append(near)
        other.append(near + step)
    forest.link(np.concatenate(one), np.concatenate(other))
    for start, size in zip(starts[sizes > leaf].tolist(), sizes[sizes > leaf].tolist()):
        search(fps[start:start + size], limit, forest, start)
    tree = np.flatnonzero(forest.label != np.arange(len(fps)))
    return fps[tree].view(np.int64), fps[forest.label[tree]].view(np.int64)


def searched(rows: DataFrame, limit: int) -> DataFrame:
    """Forest edges within nodes ``(mask, pattern)`` of at most ``GROUP`` fingerprints each."""
    inside = gray_rank(F.col("fp").bitwiseAND(F.bitwise_not("mask")))
    placed = rows.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern", inside)

    def compare(batches):
        def made(fps, mask, pattern):
            starts = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (pattern[1:] != pattern[:-1])])
            a, b = forest_edges(fps.view(np.uint64), starts, limit)
            return pa.RecordBatch.from_pydict({"u": pa.array(np.maximum(a, b)), "v": pa.array(np.minimum(a, b))})

        held = [np.empty(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("fp", "mask", "pattern"))]
            if len(held[0]) >= AT_ONCE:
                # All whole nodes; the last may go on in the next batch.
                cut = np.flatnonzero((held[1] != held[1][-1]) | (held[2] != held[2][-1]))
                if len(cut):
                    yield made(*[h[:cut[-1] + 1] for h in held])
                    held = [h[cut[-1] + 1:].copy() for h in held]
        if len(held[0]):
            yield made(*held)

    return placed.select("fp", "mask", "pattern").mapInArrow(compare, "u long, v long")


def links(fps: DataFrame, limit: int) -> DataFrame:
    """Forest edges ``(u, v)``, u above v, between distinct fingerprints ``fp`` within ``limit`` bits of each other."""
    if not 0 <= limit <= MOST_BITS:
        raise ValueError(f"the bit distance must lie between 0 and {MOST_BITS}")
    spark, found, old, masks = fps.sparkSession, None, [], [0]
    rows, node = fps.select("fp", F.lit(0).cast("long").alias("mask")), ["mask", "pattern"]
    while masks:
        # The masks of a level follow from the limit alone, (limit + 1) ** level at most.
        below = F
        for m in masks:
            below = below.when(F.col("mask") == signed(m), F.array(*[F.lit(signed(c)).cast("long") for c in parts_of(m, limit + 1)]))
        rows = rows.select("fp", F.explode(below).alias("mask")).withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask")))
        large, path = staged(rows.groupBy(node).count().where(F.col("count") > GROUP).select(node), "simhash-large")
        old.append(path)
        masks = [r["mask"] % 2 ** 64 for r in large.select("mask").distinct().collect()]
        small = rows.join(large, node, "left_anti") if masks else rows
        edges, _ = staged(searched(small, limit), "simhash-links")
        found = edges if found is None else found.unionByName(edges)
        if masks:
            rows, path = staged(rows.join(large, node, "left_semi").select("fp", "mask"), "simhash-rows")
            old.append(path)
    for path in old:
        drop_stage(spark, path)
    return found


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges ``(u, v)``: ``(node, root)`` for every node of an edge, root the smallest member.

    Each round points every node at its smallest neighbour (or itself), doubles the pointers once and contracts the edges
    along them. Components only shrink, the smallest member never moves, and no round looks at a component as a whole.
    """
    spark, maps, paths = edges.sparkSession, [], []
    current = edges.distinct()
    while True:
        current, edge_path = staged(current, "components-edges")
        if current.isEmpty():
            drop_stage(spark, edge_path)
            break
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        up, up_path = staged(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p")), "components-up")
        twice = up.join(up.select(F.col("u").alias("p"), F.col("p").alias("q")), "p").select(F.col("u").alias("node"), "q")
        twice, twice_path = staged(twice, "components-map")
        to_u = twice.select(F.col("node").alias("u"), F.col("q").alias("x"))
        to_v = twice.select(F.col("node").alias("v"), F.col("q").alias("y"))
        moved = current.join(to_u, "u").join(to_v, "v").where("x != y")
        current = moved.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct()
        maps.append(twice)
        # The edge table is read once more by the next round's write; it goes when that is done.
        paths.append((edge_path, up_path))
        if len(paths) > 1:
            for old in paths.pop(0):
                drop_stage(spark, old)
    for old in itertools.chain(*paths):
        drop_stage(spark, old)
    if not maps:
        return spark.createDataFrame([], "node long, root long")
    result = maps[0].select("node", F.col("q").alias("root"))
    for later in maps[1:]:
        step = later.select(F.col("node").alias("root"), "q")
        result = result.join(step, "root", "left").select("node", F.coalesce("q", "root").alias("root"))
    return result


# -- the operators --------------------------------------------------------------------------------------------------

def fingerprint_groups(marked: DataFrame, limit: int) -> DataFrame:
    """``(fp, root, component_id)`` for every distinct fingerprint of ``marked (doc_id, fp)``."""
    reps, _ = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fps")
    rooted = reps.join(components(links(reps, limit)).withColumnRenamed("node", "fp"), "fp", "left")
    rooted, _ = staged(rooted.select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root")


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 3, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint`` (16 hex digits), ``component_id``.

    Fingerprints link at ``max_bits`` or fewer differing bits; ``component_id`` is the smallest doc_id that links reach.
    ``max_bits`` may be 0 to ``MOST_BITS``. NULL, empty and blank texts have fingerprint zero, linked like any other; fewer words than a shingle are one shingle.
    A repeated row has its fingerprint's component. A NULL doc_id keeps its row and is never a component's id, unless no
    member has an id (then NULL). An empty table gives no rows; other columns are ignored.
    """
    marked, _ = staged(with_fingerprint(docs, ["doc_id"], text, shingle), "simhash-docs")
    groups = fingerprint_groups(marked, max_bits).select("fp", "component_id")
    return marked.join(groups, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, shingle: int = 3, max_bits: int = 3, text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of each component left, that with the smallest doc_id.

    Of repeated rows of that id one stays. Rows without an id stay (one) only where no member of the component has one.
    NULL, empty and blank texts are one group; columns of any name are kept as they are; an empty table gives none.
    """
    marked, _ = staged(with_fingerprint(docs, ["doc_id"], text, shingle), "simhash-docs")
    groups, _ = staged(fingerprint_groups(marked, max_bits), "simhash-groups")
    stay = groups.where("component_id is not null").select(F.col("component_id").alias("doc_id"))
    named = docs.join(stay, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(docs.columns)
    # The whole row travels as one value, so its columns may have any names.
    whole = docs.where("doc_id is null").select(F.struct(*docs.columns).alias("__row"), F.col(text).alias("__text_of"))
    loose = with_fingerprint(whole, ["__row"], "__text_of", shingle)
    loose = loose.join(groups.where("component_id is null").select("fp", "root"), "fp")
    return named.unionByName(loose.dropDuplicates(["root"]).select("__row.*"))
