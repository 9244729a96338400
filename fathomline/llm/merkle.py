"""Merkle manifest of a dataset: one tree per group (language), and a tree over the groups' roots.

Only the leaves and every ``STEP``-th level above them are stored, as tables. A node of a stored level is the top of an
aligned subtree over 2^STEP nodes of the stored level below, so everything between two stored levels belongs to one subtree
and is made anew from its stored descendants whenever a proof asks for it, used, and forgotten. Proofs go down level by
level: a subtree meets the one path of its top, adds the siblings of its own interior, and hands the paths to its nodes.
A subtree has 256 nodes at most, whatever the size of its group, so a group that holds most rows is many small tasks.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import staged
from fathomline.operators.sequence import number_rows
from fathomline.storage import recorded, remove_stages

#: Levels from one stored level to the next.
STEP = 8
#: The fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def framed(values):
    """Fields in a row: ``-`` for a missing one, else its bytes, ``:`` and its value."""
    texts = [v.cast("string") for v in values]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def leaf_table(docs: DataFrame, group: str = "lang", altered: dict | None = None, where=None) -> DataFrame:
    """``tree, doc_id, leaf, other``: a leaf per row, and for rows of ``where`` the leaf with the ``altered`` fields.

    ``tree`` is the group as text that sorts like it, the missing group first. Texts are hashed where they are read; only
    digests travel.
    """
    fields = {c: F.col(c) for c in FIELDS}
    leaf = F.sha2(framed(fields.values()), 256)
    other = F.when(where, F.sha2(framed((fields | (altered or {})).values()), 256)) if where is not None else F.lit(None).cast("string")
    return docs.select(F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit("")).alias("tree"), "doc_id",
                       leaf.alias("leaf"), other.alias("other"))


def interior(nodes: list[str], total: int) -> list[list[str]]:
    """Levels of one aligned subtree, from its stored nodes up to its top; ``total`` counts the whole tree's nodes there."""
    levels = [nodes]
    for _ in range(STEP):
        if total == 1:
            break
        below = levels[-1]
        levels.append([digest("".join(below[i:i + 2])) for i in range(0, len(below), 2)])
        total = (total + 1) // 2
    return levels


def paths(levels: list[list[str]]) -> list[str]:
    """Path of every stored node to the subtree's top: per level ``L`` or ``R`` and the sibling on that side, or ``-``."""
    out = []
    for i in range(len(levels[0])):
        steps = []
        for level in levels[:-1]:
            other = i ^ 1
            steps.append("-" if other >= len(level) else ("L" if i & 1 else "R") + level[other])
            i >>= 1
        out.append("".join(steps))
    return out


#: A step of a path.
STEPS = re.compile("-|[LR][0-9a-f]{64}").findall


def fold(start: str, path: str) -> str:
    """The root that a digest and its path give."""
    for step in STEPS(path):
        start = digest(start if step == "-" else step[1:] + start if step[0] == "L" else start + step[1:])
    return start


def siblings(path: str) -> str:
    """The sibling digests of a path in a row, from the leaf's level upwards."""
    return path.translate({76: None, 82: None, 45: None})


def grow(nodes: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels above ``nodes`` (``tree, total, pos, node``), lowest first, and every tree's top (``tree, node``)."""
    def tops(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        total = table.column("total")[0].as_py()
        top = interior(table.column("node").to_pylist(), total)[-1][0]
        return pa.table({"tree": table.column("tree")[:1], "total": pa.array([-(-total >> STEP) if total > 1 << STEP else 1], pa.int64()),
                         "pos": pa.array([table.column("pos")[0].as_py() >> STEP], pa.int64()), "node": pa.array([top])})

    levels, done = [nodes], []
    largest = nodes.agg(F.max("total")).first()[0] or 0
    while True:
        block = F.shiftright("pos", STEP).alias("block")
        up, _ = staged(levels[-1].select("tree", "total", "pos", "node").groupBy("tree", block).applyInArrow(
            tops, "tree string, total long, pos long, node string"), label)
        done.append(up.where("total = 1"))
        if largest <= 1 << STEP:
            break
        levels.append(up.where("total > 1"))
        largest = -(-largest >> STEP)
    roots = done[0]
    for more in done[1:]:
        roots = roots.unionByName(more)
    return levels, roots.select("tree", "node")


def descend(levels: list[DataFrame], above: DataFrame, use, schema: str, keep: list[str]) -> DataFrame:
    """``use(kept columns, nodes, paths, top row)`` of every subtree of the lowest level.

    ``above`` has a row per tree: ``tree, path`` (from the tree's top on) and further columns that are handed down.
    """
    more = [f for f in above.schema.fields if f.name not in ("tree", "path")]
    handed = "tree string, block long, path string" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in more)
    tops = above.withColumn("block", F.lit(0).cast("bigint"))

    def inner(part: pa.Table, top: pa.Table) -> pa.Table:
        part = part.sort_by("pos")
        nodes = part.column("node").to_pylist()
        over = {f.name: top.column(f.name)[0].as_py() for f in [*more]}
        made = [p + top.column("path")[0].as_py() for p in paths(interior(nodes, part.column("total")[0].as_py()))]
        return pa.table({"tree": part.column("tree"), "block": part.column("pos"), "path": pa.array(made, pa.string()),
                         **{n: pa.array([v] * len(made), top.schema.field(n).type) for n, v in over.items()}})

    def lowest(part: pa.Table, top: pa.Table) -> pa.Table:
        part = part.sort_by("pos")
        nodes = part.column("node").to_pylist()
        over = {name: top.column(name)[0].as_py() for name in top.column_names}
        made = [p + over["path"] for p in paths(interior(nodes, part.column("total")[0].as_py()))]
        return pa.table({**{c: part.column(c) for c in keep}, **use(part, nodes, made, over)})

    met = None
    for level in reversed(range(len(levels))):
        nodes = levels[level].withColumn("own", F.shiftright("pos", STEP))
        # Trees that end within this level's first block take their path from the outer tree, the others from the level above.
        here = tops.join(levels[level].where((F.col("pos") == 0) & (F.col("total") <= 1 << STEP)).select("tree"), "tree", "left_semi")
        here = here if met is None else met.unionByName(here)
        pairs = nodes.groupBy("tree", "own").cogroup(here.groupBy("tree", "block"))
        if level:
            met = pairs.applyInArrow(inner, handed)
        else:
            return pairs.applyInArrow(lowest, schema)


class Manifest:
    """Stored levels of all trees; ``groups`` has ``tree, subroot, path, root`` per group, path leading on to the root."""

    def __init__(self, docs: DataFrame, group: str = "lang", altered: dict | None = None, where=None):
        """Repeated ids are ordered by their leaves, missing ids come first; an empty table has no groups."""
        made, _ = staged(leaf_table(docs, group, altered, where), "merkle-leaves")
        placed = number_rows(made, ["tree"], [F.col("doc_id").asc_nulls_first(), "leaf"], "pos", "merkle-placed")
        sizes = made.groupBy("tree").agg(F.count("*").alias("total"))
        self.leaves, _ = staged(placed.join(sizes, "tree").withColumnRenamed("leaf", "node"), "merkle-numbered")
        self.levels, tops = grow(self.leaves, "merkle-level")
        ordered = number_rows(tops.withColumn("all", F.lit("")), ["all"], ["tree"], "pos", "merkle-roots")
        ordered, _ = staged(ordered.select(F.col("tree").alias("name"), F.col("all").alias("tree"), "pos", "node"), "merkle-roots")
        ordered = ordered.withColumn("total", F.lit(ordered.count()).cast("bigint"))
        upper, _ = grow(ordered, "merkle-upper")
        nothing = docs.sparkSession.createDataFrame([("", "")], "tree string, path string")

        def outer(part, nodes, made, over):
            return {"subroot": pa.array(nodes, pa.string()), "path": pa.array(made, pa.string()),
                    "root": pa.array([fold(n, p) for n, p in zip(nodes, made)], pa.string())}

        self.groups, _ = staged(descend(upper, nothing, outer, "name string, subroot string, path string, root string", ["name"])
                                .withColumnRenamed("name", "tree"), "merkle-groups")

    def proofs(self) -> DataFrame:
        """``doc_id, leaf, path, subroot, root`` of every row; ``fold(leaf, path)`` is the root."""
        def use(part, nodes, made, over):
            same = {c: pa.array([over[c]] * len(nodes), pa.string()) for c in ("subroot", "root")}
            return {"leaf": pa.array(nodes, pa.string()), "path": pa.array(made, pa.string()), **same}

        kind = dict(self.leaves.dtypes)["doc_id"]
        return descend(self.levels, self.groups, use, f"doc_id {kind}, leaf string, path string, subroot string, root string", ["doc_id"])

    def checked(self) -> DataFrame:
        """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``: the proof is folded from the altered leaf if there is one."""
        def use(part, nodes, made, over):
            folded = [fold(o or n, p) for n, o, p in zip(nodes, part.column("other").to_pylist(), made)]
            columns = {"leaf": nodes, "subroot": [over["subroot"]] * len(nodes), "root": [over["root"]] * len(nodes),
                       "proof_sha256": [digest(siblings(p)) for p in made], "folded_root": folded}
            return {c: pa.array(v, pa.string()) for c, v in columns.items()} | {"verified": pa.array([f == over["root"] for f in folded])}

        kind = dict(self.leaves.dtypes)["doc_id"]
        return descend(self.levels, self.groups, use, f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, "
                       "folded_root string, verified boolean", ["doc_id"])


def tampered(doc_id="doc_id"):
    """Rows whose check is made with another leaf."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 0, F.lit(False))


def manifest_check(docs: DataFrame) -> DataFrame:
    """Digests and checks of every row (see ``Manifest.checked``); where ``tampered``, n_chars is one more in the leaf that is folded.

    A missing n_chars stays missing, so that row still verifies. Rows without an id are never tampered with. The stored
    levels are removed once the result is written.
    """
    altered = {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}
    with recorded() as paths_written:
        result, path = staged(Manifest(docs, altered=altered, where=tampered()).checked(), "merkle-checked")
    remove_stages(docs.sparkSession, [p for p in paths_written if p != path])
    return result
