import corpus_pipeline
from mortar.llm import scratch
from tests.llm.fixtures import documents, empty


def test_stages_work_on_what_is_left(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == [
        "quality classifier", "line dedup", "SimHash near-dedup", "benchmark decontamination", "BPE encoding and decoding",
    ]
    docs = documents(spark)
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        docs = scratch.stored(stage(spark, docs, "/root/testdata/sf0.001"), "stage")
        if name != names[-1]:
            assert docs.columns == columns
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert before is None or ids <= before
        before = ids
    assert docs.filter("size(ids) <> n_tokens").count() == 0
    assert len(before) > 100
    run = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert run.columns == docs.columns and run.count() > 100


def test_empty_tables(spark, tmp_path):
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = scratch.stored(stage(spark, docs, "/root/testdata/sf0.001"), "stage")
        assert docs.count() == 0
    nothing = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").limit(0)
    nothing.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark, real=False)
    assert corpus_pipeline.decontaminated(spark, docs, str(tmp_path)).count() == docs.count()
