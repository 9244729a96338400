"""Exact top-k by inner product with a KD-tree per shard.

Vectors are dealt to shards of bounded size. The tree of a shard halves its vectors at the median of the dimension in which
they spread most; every node has the tightest box around its vectors. No vector of a box scores more with a query than
``sum(max(q * low, q * high))``, so a search opens nodes best bound first and ends at the first bound below the k-th score
that the query already has. Each query starts in one shard; the k-th score found there travels with it to the others, where
it cuts off most of the tree from the start. Equal bounds are still opened, so ties are settled exactly.

Trees are stored as one row per leaf (boxes of inner nodes follow from those of the leaves). A task is one shard with one
part of the queries, both of bounded size: leaves come in first, then the queries stream past.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.common import staged
from fathomline.storage import recorded, remove_stages

#: Vectors of a shard (and queries of a part), vectors of a leaf, queries whose bounds are worked out at once.
SHARD, LEAF, BLOCK = 262_144, 256, 128
#: Stands in for a missing id, which sorts behind every other.
NO_ID = 2**63 - 1
LEAVES = "dim int, shard long, leaf long, ids binary, rows binary, vectors binary"


def flat(column) -> np.ndarray:
    """The numbers of an Arrow list column in a row."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False)


def whole_numbers(values: np.ndarray, scale: float) -> np.ndarray:
    """``floor(scale * x)`` in doubles."""
    return np.floor(scale * values.astype(np.float64))


def split(vectors: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the vectors, and where the leaves start in it (with the end), 2^depth leaves in all."""
    depth = 0
    while len(vectors) > leaf << depth:
        depth += 1
    order, edges = np.arange(len(vectors)), [0, len(vectors)]
    for _ in range(depth):
        halves = [0]
        for a, b in zip(edges, edges[1:]):
            part = vectors[order[a:b]]
            widest, half = int(np.argmax(part.max(0) - part.min(0))) if b > a and part.shape[1] else 0, (b - a) // 2
            if part.shape[1] and b - a > 1:
                order[a:b] = order[a:b][np.argpartition(part[:, widest], half)]
            halves += [a + half, b]
        edges = halves
    return order, np.array(edges)


def plant(part: pa.Table, scale: float, leaf: int) -> pa.Table:
    """The leaves of one shard's tree as rows."""
    dim, n = part.column("dim")[0].as_py(), len(part)
    vectors = whole_numbers(flat(part.column("embedding")), scale).reshape(n, dim)
    order, edges = split(vectors, leaf)
    # Components beyond 64 bits are kept as doubles, which hold them exactly: they are whole multiples of a power of two.
    greatest = np.abs(vectors).max() if vectors.size else 0
    kind = next((t for t, most in ((np.int16, 2**15), (np.int32, 2**31)) if greatest < most), np.float64)
    ids = part.column("vec_id").to_numpy()[order].astype("<i8")
    rows, vectors = part.column("row").to_numpy()[order].astype("<i8"), vectors[order].astype(kind)
    bounds = list(zip(edges.tolist(), edges[1:].tolist()))
    return pa.table({
        "dim": pa.array([dim] * len(bounds), pa.int32()), "shard": pa.array([part.column("shard")[0].as_py()] * len(bounds), pa.int64()),
        "leaf": pa.array(range(len(bounds)), pa.int64()), "ids": pa.array([ids[a:b].tobytes() for a, b in bounds], pa.binary()),
        "rows": pa.array([rows[a:b].tobytes() for a, b in bounds], pa.binary()),
        "vectors": pa.array([np.dtype(kind).str.encode() + vectors[a:b].tobytes() for a, b in bounds], pa.binary())})


class Tree:
    """A shard's tree in memory. Node i has the children 2i + 1 and 2i + 2; the leaves are the last level."""

    def __init__(self, dim: int, ids: list[bytes], rows: list[bytes], vectors: list[bytes]):
        parts = [np.frombuffer(v[3:], np.dtype(v[:3].decode())) for v in vectors]
        self.edges = np.concatenate([[0], np.cumsum([len(r) // 8 for r in rows])])
        self.ids, self.rows = (np.frombuffer(b"".join(x), "<i8") for x in (ids, rows))
        self.vectors = np.concatenate(parts).astype(np.float64).reshape(len(self.rows), dim)
        self.first, self.dim = len(rows) - 1, dim
        # Below this, all sums are whole numbers that doubles hold exactly; else Python's integers do the sums.
        self.greatest = float(np.abs(self.vectors).max()) if self.vectors.size else 0.0
        low, high = [], []
        for a, b in zip(self.edges, self.edges[1:]):
            low.append(self.vectors[a:b].min(0) if b > a else np.full(dim, np.inf))
            high.append(self.vectors[a:b].max(0) if b > a else np.full(dim, -np.inf))
        low, high = [np.array(low)], [np.array(high)]
        while len(low[0]) > 1:
            low.insert(0, np.minimum(low[0][::2], low[0][1::2]))
            high.insert(0, np.maximum(high[0][::2], high[0][1::2]))
        self.low, self.high = np.concatenate(low), np.concatenate(high)
        empty = np.isinf(self.low).any(1) if dim else np.zeros(len(self.low), bool)
        self.low[empty] = self.high[empty] = 0.0

    def search(self, queries: np.ndarray, own: np.ndarray, floors: list, k: int):
        """Per query the best ``(scores, ids, rows)``, best first: all that can be among the k best scores at or above its floor."""
        exact = self.greatest * float(np.abs(queries).max() if queries.size else 0) * max(1, self.dim) < 2**53
        if exact:
            bounds = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
            vectors = self.vectors
        else:
            queries, vectors, low, high = (to_whole(x) for x in (queries, self.vectors, self.low, self.high))
            bounds = clipped(np.maximum(queries, 0).dot(high.T) + np.minimum(queries, 0).dot(low.T))
        for q, row, floor, bound in zip(queries, own, floors, bounds):
            yield self.best(vectors, q, row, floor, bound.tolist(), k)

    def best(self, vectors, q, own, floor, bound, k):
        least = floor
        scores, ids, rows = np.empty(0, vectors.dtype), np.empty(0, np.int64), np.empty(0, np.int64)
        heap = [(-bound[0], 0)]
        while heap:
            most, node = heapq.heappop(heap)
            if least is not None and -most < least:
                break
            if node < self.first:
                for child in (2 * node + 1, 2 * node + 2):
                    if least is None or bound[child] >= least:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            a, b = self.edges[node - self.first], self.edges[node - self.first + 1]
            found = vectors[a:b].dot(q)
            found = clipped(found) if found.dtype == object else found
            near = np.flatnonzero(found >= least) if least is not None else np.arange(b - a)
            near = near[self.rows[a:b][near] != own]
            if not len(near):
                continue
            scores, ids, rows = (np.concatenate(x) for x in (
                (scores, found[near]), (ids, self.ids[a:b][near]), (rows, self.rows[a:b][near])))
            if len(scores) >= k:
                top = np.lexsort((rows, ids, -scores))[:k]
                scores, ids, rows = scores[top], ids[top], rows[top]
                least = scores[-1] if least is None else max(least, scores[-1])
        return scores, ids, rows


def to_whole(x: np.ndarray) -> np.ndarray:
    """Whole numbers in doubles -> Python's integers, which have no greatest value."""
    return np.array([int(v) for v in x.ravel()] or [0], object)[:x.size].reshape(x.shape)


def clipped(scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit numbers; for those beyond, the nearest one. Bounds clipped alike stay bounds."""
    return np.minimum(np.maximum(scores, -2**63), 2**63 - 1)


def searched(units: DataFrame, scale: float, k: int) -> DataFrame:
    """Rows of ``units`` are leaves and queries of ``(dim, shard, part)``; gives ``query_row, query_id, score, vec_id, row``."""
    def run(batches):
        unit, leaves, tree = None, [], None

        def answer(part):
            dim = part.column("dim")[0].as_py()
            numbers = whole_numbers(flat(part.column("embedding")), scale).reshape(len(part), dim)
            floors = [None if f is None else int(f) for f in part.column("floor").to_pylist()]
            query_ids, own = part.column("vec_id").to_pylist(), part.column("row").to_numpy()
            out = {c: [] for c in ("query_row", "query_id", "score", "vec_id", "row")}
            for i in range(0, len(part), BLOCK):
                made = tree.search(numbers[i:i + BLOCK], own[i:i + BLOCK], floors[i:i + BLOCK], k)
                for j, (scores, ids, rows) in enumerate(made, i):
                    out["query_row"] += [int(own[j])] * len(rows)
                    out["query_id"] += [query_ids[j]] * len(rows)
                    out["score"] += map(int, scores)
                    out["vec_id"] += ids.tolist()
                    out["row"] += rows.tolist()
            return pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in out.items()})

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("dim", "shard", "part", "kind"))))
            start = 0
            while start < len(keys):
                end = start
                while end < len(keys) and keys[end] == keys[start]:
                    end += 1
                some, (*now, kind) = batch.slice(start, end - start), keys[start]
                if now != unit:
                    unit, leaves, tree = now, [], None
                if kind == 0:
                    leaves += zip(*(some.column(c).to_pylist() for c in ("ids", "rows", "vectors")))
                elif leaves or tree:
                    if tree is None:
                        tree, leaves = Tree(now[0], *map(list, zip(*leaves))), []
                    yield answer(some)
                start = end

    keys = ["dim", "shard", "part"]
    sorted_units = units.repartition(*keys).sortWithinPartitions(*keys, "kind", "leaf", "row")
    return sorted_units.mapInArrow(run, "query_row long, query_id long, score long, vec_id long, row long")


def usable(embedding="embedding"):
    """Vectors with at least one component, none of them missing or not finite."""
    bad = F.exists(F.col(embedding), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(embedding) > 0) & ~bad, F.lit(False))


def top_k(vectors: DataFrame, is_query, k: int = 10, scale: float = 1024.0, shard: int = SHARD, leaf: int = LEAF) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row of ``is_query`` its k best other rows, ties to the smaller vec_id.

    Components count as ``floor(scale * x)``. Vectors that are NULL, empty, or hold a component that is missing or not finite
    take no part; vectors of different length are never compared. A repeated id is several rows: each is a candidate, and a
    query of its own, for the others. A missing id is no query by its id and comes last among ties. Scores beyond 64 bits
    count as the nearest 64-bit number. An empty table gives no rows. Other columns play no part.
    """
    with recorded() as written:
        rows, _ = staged(vectors.where(usable()).select(
            "vec_id", F.col("embedding"), F.size("embedding").alias("dim"), F.coalesce(is_query, F.lit(False)).alias("asked"),
            F.monotonically_increasing_id().alias("row")), "kd-rows")
        # A row for each length of vector, written, so that the planner knows its size and does not shuffle the rows for it.
        sizes, _ = staged(rows.groupBy("dim").agg(
            F.ceil(F.count("*") / shard).alias("shards"), F.ceil(F.count_if("asked") / shard).alias("parts")), "kd-sizes")
        most = sizes.agg(F.max("shards")).first()[0] or 0
        dealt = rows.join(sizes, "dim").withColumns({
            "shard": F.pmod(F.xxhash64("row"), F.col("shards")), "vec_id": F.coalesce(F.col("vec_id").cast("bigint"), F.lit(NO_ID))})
        trees, _ = staged(dealt.select("dim", "shard", "vec_id", "row", "embedding").groupBy("dim", "shard").applyInArrow(
            lambda part: plant(part, scale, leaf), LEAVES), "kd-trees")
        none = {c: F.lit(None).cast("binary") for c in ("ids", "rows", "vectors")}
        empty = F.lit(None).cast(dict(rows.dtypes)["embedding"])
        asked = dealt.where("asked").withColumns(none | {"kind": F.lit(1), "leaf": F.lit(0).cast("bigint")})
        shape = ["dim", "shard", "part", "kind", "leaf", "ids", "rows", "vectors", "row", "vec_id", "embedding", "floor"]

        def found(queries, parts):
            ready = trees.join(sizes, "dim").withColumns({
                "part": F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)), "kind": F.lit(0), "row": F.lit(0).cast("bigint"),
                "vec_id": F.lit(0).cast("bigint"), "embedding": empty, "floor": F.lit(None).cast("bigint")})
            return searched(ready.select(*shape).unionByName(queries.select(*shape)), scale, k)

        # A shard asks for about the same share of the queries as it holds of the rows: one part.
        home, _ = staged(found(asked.withColumns({"part": F.lit(0).cast("bigint"), "floor": F.lit(None).cast("bigint")}),
                               F.lit(1).cast("bigint")), "kd-home")
        if most > 1:
            known = home.groupBy(F.col("query_row").alias("row")).agg(
                F.when(F.count("*") >= k, F.min("score")).alias("floor"))
            others = F.filter(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1), lambda s: s != F.col("shard"))
            again = asked.join(known, "row", "left").withColumn("part", F.pmod(F.xxhash64("row", F.lit(1)), F.col("parts")))
            again = again.where("shards > 1").withColumn("shard", F.explode(others))
            home = home.unionByName(found(again, F.greatest("parts", F.lit(1)).cast("bigint")))
        # At most k rows of a query from each shard.
        order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
        best = home.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        made, path = staged(best.select("query_id", "rank", F.when(F.col("vec_id") < NO_ID, F.col("vec_id")).alias("vec_id"), "score"), "kd-best")
    remove_stages(vectors.sparkSession, [p for p in written if p != path])
    return made


def nearest_by_id(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """Queries are the rows whose vec_id ``every`` divides."""
    return top_k(vectors, F.col("vec_id") % every == 0, k)


OP12_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e, row_number() OVER () AS r FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.r <> c.r
  WHERE q.vec_id % 100 = 0 AND len(q.e) = len(c.e)),
k AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM p)
SELECT * FROM k WHERE rank <= 10"""
