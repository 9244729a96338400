"""Fill-in-middle: a text is cut twice and its parts are put in another order, so that a model learns to write the middle.

Cuts are asked for in units (code points, words or lines). A text is laid out as fixed blocks of UTF-8 bytes, and a Fenwick
tree over the blocks holds how many units start in them and how many code points. A cut is found by binary lifting: the
descent adds whole ranges of blocks while their units stay within the number asked for, which gives the block and, from the
second count, the code points before it; only that block is then looked at. Texts are never split into lists of units.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import pieces

#: Bytes of a block.
BLOCK = 4096
#: The marks before prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
#: ASCII white space, by byte.
BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def unit_starts(data: np.ndarray, unit: str) -> np.ndarray:
    """True at each byte that starts a unit; what stands before the first unit belongs to the prefix of every cut but 0."""
    if unit == "char":
        return (data & 0xC0) != 0x80
    if unit == "word":
        blank = BLANK[data]
        return ~blank & np.concatenate([[True], blank[:-1]])
    if unit == "line":
        return np.concatenate([[True], data[:-1] == 10])
    raise ValueError(f"no unit {unit}: char, word or line")


class TextCuts:
    """Fenwick tree over the blocks of one text (UTF-8 bytes); row 0 counts unit starts, row 1 code points."""

    def __init__(self, text: bytes, unit: str = "char"):
        self.data = np.frombuffer(text, np.uint8)
        self.starts = unit_starts(self.data, unit) if len(text) else np.empty(0, bool)
        self.points = self.starts if unit == "char" else unit_starts(self.data, "char") if len(text) else self.starts
        edges = np.arange(0, len(text), BLOCK)
        sums = np.zeros((2, len(edges) + 1), np.int64)
        if len(edges):
            for row, marks in enumerate((self.starts, self.points)):
                np.cumsum(np.add.reduceat(marks, edges, dtype=np.int64), out=sums[row, 1:])
        # Entry i of the tree covers the lowbit(i) blocks that end with block i.
        at = np.arange(len(edges) + 1)
        self.tree = sums - sums[:, at - (at & -at)]
        self.units, self.chars = (int(s) for s in sums[:, -1])
        self.lift = 1 << max(0, len(edges).bit_length() - 1)

    def cut(self, n: int) -> tuple[int, int]:
        """Bytes and code points before unit ``n`` (0-based); the whole text when it has no more than ``n`` units."""
        if n <= 0:
            return 0, 0
        if n >= self.units:
            return len(self.data), self.chars
        tree, block, left, points, step = self.tree, 0, n, 0, self.lift
        while step:
            onward = block + step
            if onward < tree.shape[1] and tree[0, onward] <= left:
                block, left, points = onward, left - int(tree[0, onward]), points + int(tree[1, onward])
            step >>= 1
        start = block * BLOCK
        place = int(np.flatnonzero(self.starts[start:start + BLOCK])[left])
        return start + place, points + int(np.count_nonzero(self.points[start:start + place]))


def numbers(seed: str, doc_id) -> tuple[int, int, int, int]:
    """The first four 8-digit groups of the sha256 of ``seed:doc_id``."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4))


def arranged(text: bytes, drawn, unit: str, marks: list[bytes], plain_from: int, spm_below: int):
    """``form, output, prefix_chars, middle_chars, n_chars`` of one text; the two counts are None where it stays plain."""
    cuts = TextCuts(text, unit)
    if not text or any(m in text for m in marks) or drawn[2] % 100 >= plain_from:
        return "plain", text, None, None, cuts.chars
    first, second = sorted(h % (cuts.units + 1) for h in drawn[:2])
    (a, a_chars), (b, b_chars) = cuts.cut(first), cuts.cut(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = marks
    spm = drawn[3] % 100 < spm_below
    output = b"".join((s, suffix, p, prefix, m, middle) if spm else (p, prefix, s, suffix, m, middle))
    return "spm" if spm else "psm", output, a_chars, b_chars - a_chars, cuts.chars


def fill_in_middle(docs: DataFrame, seed: str = "1", unit: str = "char", plain_from: int = 90, spm_below: int = 20,
                   marks: tuple[str, str, str] = MARKS, text: str = "text") -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for every row, whole texts.

    The draw depends on ``seed`` and doc_id alone, so rows that repeat an id are cut by the same numbers. A text that is
    empty or holds a mark stays as it is (``plain``), as do those that draw ``plain_from`` or more of 100. NULL texts are
    empty; a NULL id draws as an empty one; an empty table gives no rows; other columns play no part.
    """
    source = docs.select("doc_id", F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("t"))
    raw = [m.encode() for m in marks]

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "t"):
                ids, texts = piece.column("doc_id"), piece.column("t").to_pylist()
                rows = [arranged(t, numbers(seed, i), unit, raw, plain_from, spm_below) for i, t in zip(ids.to_pylist(), texts)]
                form, output, prefix, middle, n = zip(*rows)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": ids, "n": pa.array(n, pa.int64()), "form": pa.array(form), "prefix_chars": pa.array(prefix, pa.int64()),
                    "middle_chars": pa.array(middle, pa.int64()), "output": pa.array(output, pa.binary()).cast(pa.string())})

    kind = dict(source.dtypes)["doc_id"]
    return source.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output="output", form="form", marks: tuple[str, str, str] = MARKS):
    """The original text as a column over output and form: no part holds a mark, so the marks split the output into its parts."""
    parts = F.split(F.col(output), "|".join(rf"\Q{m}\E" for m in marks), -1)
    one, two, three = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return F.when(F.col(form) == "psm", F.concat(one, three, two)).when(F.col(form) == "spm", F.concat(two, three, one)).otherwise(F.col(output))


def fim_digests(docs: DataFrame, **options) -> DataFrame:
    """Digests of every output and of the text rebuilt from it."""
    made = fill_in_middle(docs, **options)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output"), 256).alias("output_sha256"),
                       F.sha2(restored(), 256).alias("restored_sha256"))


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || doc_id) AS s FROM documents),
h AS (SELECT *, CAST('0x' || s[1:8] AS BIGINT) % (n + 1) AS c1, CAST('0x' || s[9:16] AS BIGINT) % (n + 1) AS c2,
  CAST('0x' || s[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || s[25:32] AS BIGINT) % 100 AS h4 FROM d),
f AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR
  contains(t, '<M>') OR h3 >= 90 THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256
FROM p"""
