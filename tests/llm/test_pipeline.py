"""The corpus pipeline, stage by stage."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from pageflow.llm import decontamination, mixing, quality, similarity

SF = "/root/testdata/sf0.001"


def test_stages_apply_their_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.quality_stage(spark, docs, SF)
    assert good.columns == docs.columns
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    one = corpus_pipeline.jaccard_stage(spark, good, SF)
    assert sorted(r.doc_id for r in one.collect()) == sorted({r.component_id for r in similarity.jaccard_groups(good).collect()})
    clean = corpus_pipeline.decontamination_stage(spark, one, SF)
    bad = {r.doc_id for r in decontamination.leaks(one, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in one.collect()} - bad
    uses = Counter({r.doc_id: r.uses for r in mixing.mix_plan(clean).collect() if r.uses})
    mixed = corpus_pipeline.mixing_stage(spark, clean, SF)
    assert mixed.columns == docs.columns and Counter(r.doc_id for r in mixed.collect()) == uses
    shards = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in shards) == uses and {r.shard for r in shards} <= set(range(40))
