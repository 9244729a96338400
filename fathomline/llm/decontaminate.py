"""Benchmark decontamination: size-partitioned MinHash containment search for short test items in long documents, DataFrame only.

Containment is measured against the item: the share of its distinct shingles that a document has. A document that has at
least the share t of an item's n shingles misses at most ``n - ceil(t n)`` of them, so of any ``n - ceil(t n) + 1`` it has
one. The sketch of an item is its so many smallest MinHash values. Items are partitioned by size (powers of two); a
partition knows the least number of shingles that one of its items asks for and the greatest value in its sketches.

The signature of a document is its MinHash values up to the greatest bound of all partitions that it is large enough for:
a document of N shingles skips the partitions whose items ask for more. Signatures are not cut to a fixed length, so however
long the document, no item can be missed, unlike with bands of rows, whose chance falls with the ratio of sizes. Values that
meet in both make a candidate, which is verified by exact containment of shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.common import drop_stage, staged

#: Words in a shingle and least containment.
SHINGLE, LEAST = 5, 0.8
#: Sketch rows up to which they are broadcast (some 40 bytes each); above it they are joined by a shuffle.
BROADCAST_ROWS = 100_000
#: Parts into which a value that very many documents share is dealt for that shuffle.
SALTS = 16


def words_of(text) -> Column:
    """Runs of letters and digits in lower case; NULL has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles_of(words) -> Column:
    """Distinct shingles, as texts; none for fewer words than a shingle."""
    several = F.transform(F.sequence(F.lit(1), F.size(words) - (SHINGLE - 1)),
                          lambda i: F.concat_ws(" ", F.slice(words, i, SHINGLE)))
    return F.array_distinct(F.when(F.size(words) >= SHINGLE, several).otherwise(F.array().cast("array<string>")))


def minhash(words) -> Column:
    """MinHash value of a shingle given as a list of words."""
    return F.xxhash64(words)


def sketches(items: DataFrame, least: float, text: str) -> DataFrame:
    """``item_id, part, need, value``: an item's smallest MinHash values, as many as its size asks for; its partition by size and
    the number of shingles that a document must have of it."""
    listed = items.select("item_id", F.explode(shingles_of(words_of(F.col(text)))).alias("shingle")).distinct()
    values = listed.select("item_id", minhash(F.split("shingle", " ")).alias("value"))
    whole = values.groupBy("item_id").agg(F.array_sort(F.collect_list("value")).alias("all"))
    size = F.size("all")
    need = F.ceil(size * F.lit(least))
    kept = F.slice("all", F.lit(1), (size - need + 1).cast("int"))
    return whole.select("item_id", F.floor(F.log2(size)).cast("int").alias("part"), need.cast("long").alias("need"), F.explode(kept).alias("value"))


def partitions(sketch: DataFrame) -> list[tuple[int, int]]:
    """``(least need, greatest sketch value)`` of each partition by size; sizes are powers of two, so there are 31 at most."""
    rows = sketch.groupBy("part").agg(F.min("need").alias("need"), F.max("value").alias("bound")).collect()
    return sorted((r["need"], r["bound"]) for r in rows)


def signature(words, parts: list[tuple[int, int]]) -> Column:
    """The MinHash values of a document up to the bound of the partitions it is large enough for; none where there are none."""
    places = F.size(words) - (SHINGLE - 1)
    limit, bound = F.lit(None).cast("bigint"), None
    for need, top in parts:
        # From the smallest items up: the last partition that the document is large enough for decides.
        bound = top if bound is None else max(bound, top)
        limit = F.when(places >= max(need, 1), F.lit(bound)).otherwise(limit)
    none = F.array().cast("array<bigint>")
    if bound is None:
        return none
    values = F.transform(F.sequence(F.lit(1), places), lambda i: minhash(F.slice(words, i, SHINGLE)))
    return F.when(places >= max(parts[0][0], 1), F.array_distinct(F.filter(values, lambda v: v <= limit))).otherwise(none)


def contaminated(docs: DataFrame, items: DataFrame, least: float = LEAST, text: str = "text", item_text: str = "text") -> DataFrame:
    """``doc_id, item_id, n_shared, n_item, containment`` for every document that holds at least ``least`` of an item.

    Items with fewer than five words have no shingle and are found nowhere; rows of one item_id are one item; a NULL
    item_id is not an item. NULL and short texts hold nothing. Rows of one doc_id count as one document; without a doc_id a
    row cannot be named and is not reported. Empty tables give no rows; other columns are ignored.
    """
    named = docs.where("doc_id is not null").select("doc_id", words_of(F.col(text)).alias("words"))
    items = items.where("item_id is not null").select("item_id", F.col(item_text).alias("item_text"))
    sketch, sketch_path = staged(sketches(items, least, "item_text"), "decontaminate-sketch")
    parts = partitions(sketch)
    small = sketch.count() <= BROADCAST_ROWS
    signed = named.select("doc_id", (F.size("words") - (SHINGLE - 1)).alias("places"), signature(F.col("words"), parts).alias("values"))
    # With explode, a filter on the values' size would be inferred and moved below, where it splits the text again for every
    # word; the NULL that explode_outer makes of an empty signature meets nothing.
    marks = signed.select("doc_id", "places", F.explode_outer("values").alias("value"))
    asked = sketch.select("item_id", "need", "value")
    if small:
        met = marks.join(F.broadcast(asked), "value")
    else:
        # A passage that many documents share: its values are dealt over several parts, the sketches copied to each.
        dealt = asked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
        met = marks.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).join(dealt, ["value", "salt"])
    met = met.where(F.col("places") >= F.col("need")).select("doc_id", "item_id").distinct()
    candidates, candidate_path = staged(met, "decontaminate-candidates")
    shingles = items.select("item_id", F.explode(shingles_of(words_of(F.col("item_text")))).alias("shingle")).distinct()
    whole = shingles.groupBy("item_id").agg(F.collect_list("shingle").alias("item_shingles"))
    # Candidate documents only: their shingles are made once a document, then held against each of its items.
    chosen = candidates.select("doc_id").distinct()
    held = named.join(chosen, "doc_id", "left_semi").select("doc_id", F.explode(shingles_of(F.col("words"))).alias("shingle"))
    asked = candidates.join(shingles, "item_id")
    shared = held.distinct().join(asked, ["doc_id", "shingle"]).groupBy("doc_id", "item_id").agg(F.count("*").alias("n_shared"))
    sized = shared.join(whole.select("item_id", F.size("item_shingles").cast("long").alias("n_item")), "item_id")
    found = sized.where(F.col("n_shared") >= F.ceil(F.col("n_item") * F.lit(least)))
    found = found.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))
    found, _ = staged(found, "decontaminate-found")
    drop_stage(docs.sparkSession, sketch_path)
    drop_stage(docs.sparkSession, candidate_path)
    return found


def decontaminate(docs: DataFrame, items: DataFrame, least: float = LEAST, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose document holds no item; rows without a doc_id stay."""
    return docs.join(contaminated(docs, items, least, text).select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


#: The same containment without sketches: every shingle of every item against every shingle of every document.
OP1_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
           FROM documents WHERE doc_id IS NOT NULL),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w
      FROM benchmark WHERE item_id IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
       FROM d WHERE len(w) >= 5),
bs AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
       FROM b WHERE len(w) >= 5),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment
FROM m JOIN n USING (item_id) WHERE n_shared >= ceil(n_item * 0.8)
"""
