"""A training corpus from documents: each stage is written as Parquet and reread as the next one's documents.

Toxic documents go, one document of each group of near copies stays, documents that hold a benchmark item go, sources are
mixed with a limit of repetitions (no document is lost), and the token ids are written to Arrow files.
"""

from __future__ import annotations

from fathomline.llm import decontaminate, mixing, packing, simhash, toxicity
from fathomline.llm.common import staged, table
from fathomline.llm.registry import END_ID, MAX_REPEAT, tokenizer_path


def toxic_out(spark, docs, sf_dir):
    """Documents that score below 0.7; the field is trained on the labelled rows of the whole table."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def near_duplicates(spark, docs, sf_dir):
    """The document with the smallest id of each component of fingerprints within 3 bits."""
    return simhash.simhash_dedup(docs, shingle=3, max_bits=3)


def benchmark_out(spark, docs, sf_dir):
    """Documents that hold less than 0.8 of every benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), least=0.8)


def mix(spark, docs, sf_dir):
    """Every document at least once; small sources repeated up to MAX_REPEAT times as often as the largest."""
    return mixing.remix(docs, max_repeat=MAX_REPEAT)


def pack(spark, docs, sf_dir):
    """``doc_id, start, n_tokens, ids_crc32`` of every row, read back from the files."""
    return packing.pack(docs, tokenizer_path(), END_ID)


STAGES = [("toxicity", toxic_out), ("simhash near-dedup", near_duplicates), ("decontamination", benchmark_out), ("mixing", mix), ("packing", pack)]

#: A trained model and a tokenizer take part, which SQL cannot express; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
