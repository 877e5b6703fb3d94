import corpus_pipeline
from tradeledger.llm import queries

from . import corpus


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    rng = corpus.seeded(30)
    text = [" ".join(corpus.words(rng, 120, 5000)) for _ in range(12)]
    rows = [(i, t, "en" if i % 2 else "fr", "s", len(t)) for i, t in enumerate(text)]
    rows += [(50, text[3], "en", "s", 1), (51, None, None, None, None), (52, "", "en", "s", 0)]
    corpus.frame(spark, rows, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for k, (_name, stage) in enumerate(corpus_pipeline.STAGES, 1):
        docs = stage(spark, docs, str(tmp_path))
        if k < len(corpus_pipeline.STAGES):
            docs.write.parquet(f"{tmp_path}/stage{k}")
            docs = spark.read.parquet(f"{tmp_path}/stage{k}")
            assert docs.columns == columns
    ids = {r["doc_id"] for r in docs.collect()}
    assert 50 not in ids and 51 not in ids and 52 not in ids and 3 in ids


def test_names():
    assert len(corpus_pipeline.STAGES) == 5
    assert [name.split("_")[0] for name in queries.queries()] == [f"op{n}" for n in range(1, 11)]
    assert set(queries.oracle_sql()) <= set(queries.queries())
