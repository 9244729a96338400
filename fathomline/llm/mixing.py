"""Temperature mixing of sources, realised as budgeted block permutations.

Weights are token shares raised to an exponent and normalised: 1 keeps the shares, 0 makes all sources equal. The exponent
is found by bisection: the largest one whose weights reach a target entropy, or the smallest that keeps every source within
a limit of repetitions. Weights are realised exactly as whole documents: a source is cut into blocks by a hash of its
documents, every epoch is a permutation of its blocks, whole epochs come first, and the last epoch takes blocks until the
source's token budget is met (inside the last block, documents in hash order).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.common import same_key, staged

#: Blocks of a source; a block is cut inside one task, so it grows with 1 / BLOCKS of the largest source.
BLOCKS = 4096
#: Steps of the bisection; each halves the interval of the exponent.
STEPS = 50
#: Sources that are handled as a list on the driver; with more of them mixing is refused rather than cut.
MOST_SOURCES = 1_000_000


def tempered(shares: list[float], exponent: float) -> list[float]:
    """Normalised powers of shares; a share of zero stays zero."""
    powers = [math.exp(exponent * math.log(s)) if s > 0 else 0.0 for s in shares]
    total = sum(powers) or 1.0
    return [p / total for p in powers]


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def repetition(shares: list[float], weights: list[float]) -> float:
    """The most often repeated source's epochs, when the least repeated one is passed exactly once."""
    ratios = [w / s for s, w in zip(shares, weights) if s > 0]
    return max(ratios) / min(ratios) if ratios else 1.0


def find_exponent(shares: list[float], target_entropy: float | None = None, max_repeat: float | None = None) -> float:
    """The exponent in [0, 1] nearest to 1 that reaches the entropy, or nearest to 0 that obeys the limit.

    Entropy falls and repetition falls as the exponent rises. A target beyond reach gives the end of the interval.
    """
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        weights = tempered(shares, middle)
        if target_entropy is not None:
            low, high = (middle, high) if entropy(weights) >= target_entropy else (low, middle)
        else:
            low, high = (low, middle) if repetition(shares, weights) <= max_repeat else (middle, high)
    return low if target_entropy is not None else high


def plan(docs: DataFrame, tokens, target_entropy: float | None = None, max_repeat: float | None = None, budget: float | None = None):
    """``[(source, tokens, weight, epochs)]``, from totals over all rows.

    Without a budget no document is dropped: the least repeated source is passed exactly once.
    """
    totals = docs.groupBy("source").agg(F.sum(tokens).alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    totals = sorted(((r["source"], int(r["n"] or 0)) for r in totals), key=lambda r: (r[0] is not None, r[0]))
    every = sum(n for _, n in totals)
    shares = [n / every if every else 0.0 for _, n in totals]
    weights = tempered(shares, find_exponent(shares, target_entropy, max_repeat))
    if budget is None:
        budget = max((n / w for (_, n), w in zip(totals, weights) if w > 0), default=0.0)
    return [(s, n, w, w * budget / n if n else 1.0) for (s, n), w in zip(totals, weights)]


def word_count(text):
    """Tokens by default: words between white space."""
    trimmed = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D ]+", " "))
    return F.when(trimmed == "", 0).otherwise(F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit(""))) + 1).cast("long")


def copies(docs: DataFrame, key: list[str], seed: int = 0, target_entropy: float | None = None, max_repeat: float | None = None,
           budget: float | None = None, text: str = "text") -> DataFrame:
    """The key columns, ``source, n_tokens, block, copies``: how often each row is taken.

    ``copies`` is the source's whole epochs, and one more for rows of the partial epoch. Rows without tokens come with
    whole epochs only. NULL is a source of its own.
    """
    spark = docs.sparkSession
    slim = docs.select(*key, "source", word_count(F.col(text)).alias("n_tokens"), F.xxhash64(F.lit(seed), *key, F.col(text)).alias("draw"))
    slim, _ = staged(slim.withColumn("block", F.pmod("draw", F.lit(BLOCKS)).cast("int")), "mixing-rows")
    rows = [(s, float(w), math.floor(e + 1e-9), (e - math.floor(e + 1e-9)) * n) for s, n, w, e in plan(slim, F.col("n_tokens"), target_entropy, max_repeat, budget)]
    quota = spark.createDataFrame(rows, "name string, weight double, whole long, rest double")
    shuffled = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "source", "block"), "block")
    blocks = slim.groupBy("source", "block").agg(F.sum("n_tokens").alias("n"))
    blocks = blocks.withColumn("before", F.sum("n").over(shuffled) - F.col("n"))
    placed = blocks.join(quota, same_key(blocks["source"], quota["name"])).select(
        F.col("source").alias("of"), F.col("block").alias("at"), "n", "before", "whole", "weight", (F.col("rest") - F.col("before")).alias("left"))
    joined = slim.join(placed, same_key(slim["source"], placed["of"]) & (slim["block"] == placed["at"]))
    # Only the block in which a source's budget ends is put in order, a 1 / BLOCKS part of the source.
    edge = (F.col("left") > 0) & (F.col("left") < F.col("n"))
    inside = Window.partitionBy("source", "block").orderBy("draw", *key)
    cut = joined.where(edge).withColumn("run", F.sum("n_tokens").over(inside))
    last = [*key, "source", "n_tokens", "block"]
    once = F.when(F.col("left") >= F.col("n"), (F.col("n_tokens") > 0).cast("long")).otherwise(0)
    return (joined.where(~edge).select(*last, (F.col("whole") + once).alias("copies"))
            .unionByName(cut.select(*last, (F.col("whole") + ((F.col("run") <= F.col("left")) & (F.col("n_tokens") > 0)).cast("long")).alias("copies"))))


def mixture(docs: DataFrame, seed: int = 0, target_entropy: float | None = None, max_repeat: float | None = None, budget: float | None = None,
            text: str = "text") -> DataFrame:
    """``doc_id, source, n_tokens, epoch, block, draw_order``: one row per copy taken.

    Sorting by ``draw_order`` gives an epoch's blocks in their permuted order. NULL and empty texts have no tokens, NULL
    is a source of its own, repeated rows are rows of their own, an empty table gives no rows, other columns are ignored.
    """
    taken = copies(docs, ["doc_id"], seed, target_entropy, max_repeat, budget, text)
    taken = taken.where("copies > 0").select("doc_id", "source", "n_tokens", "block", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("epoch"))
    return taken.select("doc_id", "source", "n_tokens", F.col("epoch").cast("int").alias("epoch"), "block",
                        F.xxhash64(F.lit(seed), "source", "epoch", "block").alias("draw_order"))


def remix(docs: DataFrame, seed: int = 0, target_entropy: float | None = None, max_repeat: float | None = None, budget: float | None = None,
          text: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it, with their own columns only.

    Rows that agree in all of doc_id, source and text are taken alike; rows that share an id but not the text are taken
    each for itself. NULL ids, sources and texts are values like others (NULL texts have no tokens); an empty table gives none.
    """
    marked = docs.withColumn("__digest", F.xxhash64(F.col(text)))
    taken = copies(marked, ["doc_id", "__digest"], seed, target_entropy, max_repeat, budget, text)
    times = taken.groupBy("doc_id", "source", "__digest").agg(F.max("copies").alias("__copies")).withColumnsRenamed(
        {"doc_id": "__doc", "source": "__source", "__digest": "__of"})
    joined = marked.join(times, same_key(marked["doc_id"], F.col("__doc")) & same_key(marked["source"], F.col("__source"))
                         & (marked["__digest"] == F.col("__of")), "left")
    again = F.explode(F.sequence(F.lit(1), F.coalesce("__copies", F.lit(1)))).alias("__copy")
    return joined.where(F.coalesce("__copies", F.lit(1)) > 0).select(*docs.columns, again).select(docs.columns)
