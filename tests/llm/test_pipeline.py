from __future__ import annotations

import corpus_pipeline

TABLES = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_pack_what_is_left(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, TABLES).persist()
        after = docs.count()
        assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars"} and 0 < after <= before, name
        before = after
    assert docs.where("n_chars <> length(text)").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, TABLES)
    assert packed.select("doc_id").distinct().count() == before
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 4096").count() == 0
