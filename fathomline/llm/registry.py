"""Queries of the package, each over its whole table with production parameters, and the SQL they are checked against."""

from __future__ import annotations

from fathomline.llm import (decontaminate, fim, kdsearch, licences, merkle, mixing, packing, pagetext, quality, simhash, tokens,
                            toxicity, warc)
from fathomline.llm.common import table

#: The tokenizer file of the queries; its folder is looked up when a query runs.
TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
#: Epochs that no source of a mixture may exceed, against the least repeated one.
MAX_REPEAT = 1.5


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), least=0.8)


def op2_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


def op3_main_text(spark, sf_dir):
    return pagetext.main_text(table(spark, sf_dir, "pages"))


def op4_warc(spark, sf_dir):
    return warc.archive(table(spark, sf_dir, "pages"), least=0)


def op5_licences(spark, sf_dir):
    return licences.licences(table(spark, sf_dir, "documents"))


def op6_simhash(spark, sf_dir):
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op7_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


def op8_token_counts(spark, sf_dir):
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), limit=1024)


def op9_mixing(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"), max_repeat=MAX_REPEAT)


def op10_quality(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle(spark, sf_dir):
    return merkle.manifest_check(table(spark, sf_dir, "documents"))


def op12_topk(spark, sf_dir):
    return kdsearch.nearest_by_id(table(spark, sf_dir, "embeddings"), every=100, k=10)


def op13_fim(spark, sf_dir):
    return fim.fim_digests(table(spark, sf_dir, "documents"))


QUERIES = {q.__name__: q for q in (
    op1_decontaminate, op2_toxicity, op3_main_text, op4_warc, op5_licences, op6_simhash, op7_packing, op8_token_counts, op9_mixing, op10_quality,
    op11_merkle, op12_topk, op13_fim)}
SQL = {"op1_decontaminate": decontaminate.OP1_SQL, "op12_topk": kdsearch.OP12_SQL, "op13_fim": fim.OP13_SQL}
