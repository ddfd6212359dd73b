from collections import Counter

import corpus_pipeline
from viewpulse.llm.common import stored


def test_stages_on_sample_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf), name)
        now = Counter(r.doc_id for r in docs.select("doc_id").collect())
        assert now and set(now) <= before
        if name != "packing":
            assert docs.columns == columns
        if name == "line_dedup":
            assert set(now) == before
        if name == "near_dedup":
            assert set(now.values()) == {1}
        before = set(now)
    run = corpus_pipeline.run(spark, sf)
    assert Counter(run.columns) == Counter(docs.columns)
    whole = lambda df: Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert sum(r.length for r in run.collect()) == sum(r.length for r in docs.collect())
    assert {k[0] for k in whole(run)} == {k[0] for k in whole(docs)}


def test_stages_on_odd_rows(spark, odd, none, sf):
    for frame in (odd, none):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, sf), name)
            docs.count()
