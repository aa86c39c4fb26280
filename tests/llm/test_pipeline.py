from pyspark.sql import functions as F

import corpus_pipeline as C

SF = "/root/testdata/sf0.01"


def test_stages_hand_on_documents_and_runs_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = docs
    for name, stage in C.STAGES:
        out = stage(spark, out, SF)
        if name != "sentencepiece":
            assert out.columns == docs.columns, name
    last = out.cache()
    assert last.where("not lossless").count() == 0
    assert 0 < last.select("doc_id").distinct().count() < docs.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0")
    kept = last.select("doc_id").distinct().join(labels, "doc_id").count()
    assert kept > 0.85 * labels.count()  # what goes beside toxic rows are near copies
    assert last.where(F.col("text").rlike("AKIA[A-Z0-9]{16,}")).count() == 0
    rows = lambda df: sorted(map(tuple, df.select("doc_id", "pieces").collect()))
    assert rows(C.run(spark, SF)) == rows(last)


def test_stages_on_edge_rows(spark, edge, empty):
    for name, stage in C.STAGES:
        assert stage(spark, edge, SF).count() > 0, name
        assert stage(spark, empty, SF).count() == 0, name
