"""The pipeline, stage by stage, on the small tables."""

import corpus_pipeline


def test_stages_keep_what_they_should(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = held.select("doc_id").distinct().count()
        held, _ = corpus_pipeline.staged(stage(spark, held, sf_dir), "test-stage")
        assert held.columns == docs.columns, name
        after = held.select("doc_id").distinct().count()
        assert (after == before) if name == "mixing" else (0.5 * before < after <= before), name
    packed = corpus_pipeline.STAGES[-1][1](spark, held, sf_dir).toPandas().sort_values("start")
    assert len(packed) == held.count()
    assert (packed.start.iloc[1:].values == packed.n_tokens.cumsum().iloc[:-1].values).all()
