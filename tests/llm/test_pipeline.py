import corpus_pipeline


def test_pipeline_on_the_smallest_tables(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    from tidewater.llm.common import saved
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = saved(stage(spark, docs, d), f"test-{name}")
        assert out.columns == docs.columns
        assert out.count() == docs.count() if name == "substrings" else 0 < out.count() <= n
        docs, n = out, out.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, d)
    assert pieces.select("doc_id").distinct().count() == n
