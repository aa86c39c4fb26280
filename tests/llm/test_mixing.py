import pytest
from pyspark.sql import functions as F

from tidemill.llm import mixing as X

SF = "/root/testdata/sf0.01"


def fill(sizes, weights, budget, most):
    """Plain water-filling."""
    target, free = dict.fromkeys(sizes, 0.0), {s for s in sizes if weights[s] > 0}
    while free:
        left = budget - sum(target[s] for s in sizes if s not in free)
        level = left / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] >= most * sizes[s]}
        if not over:
            return target | {s: level * weights[s] for s in free}
        target |= {s: most * sizes[s] for s in over}
        free -= over
    return target


def test_targets_and_words_taken(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    weights = X.ranked_weights(docs, [5, 2, 1])
    rows = X.mix(docs, weights).select("row.doc_id", "row.text", "row.source", "size", "source_size", "target", "times").toPandas()
    assert (rows["size"] == rows["text"].map(lambda t: len(t.encode().split()))).all()
    sizes = rows.groupby("source")["size"].sum().to_dict()
    given = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    assert {r.source: r.weight for r in weights.collect()} == given
    want = fill(sizes, given, 1.5 * sum(sizes.values()), 2)
    rows["taken"] = rows["size"] * rows["times"]
    for source, g in rows.groupby("source"):
        assert g["target"].iloc[0] == pytest.approx(want[source])
        assert abs(g["taken"].sum() - want[source]) <= g["size"].max() / 2 + 1
    assert rows["times"].between(0, 2).all()
    again = X.mix(docs.repartition(7), weights).select("row.doc_id", "times").toPandas().set_index("doc_id")["times"]
    assert again.sort_index().equals(rows.set_index("doc_id")["times"].sort_index())


def test_least_epochs_keep_every_row(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    mixed = X.mixed_documents(docs, X.ranked_weights(docs, [5, 2, 1]), least_epochs=1.0)
    assert mixed.columns == docs.columns
    counts = mixed.groupBy("doc_id").count()
    assert counts.count() == docs.count() and counts.agg(F.max("count")).first()[0] == 2


def test_sources_without_words_stand_least_epochs_times(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "", "y"), (3, None, "y"), (4, " ", None)], "doc_id long, text string, source string")
    weights = X.ranked_weights(docs, [5, 2, 1])
    mixed = X.mixed_documents(docs, weights, least_epochs=1.0).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in mixed if r.doc_id > 1} == {2: 1, 3: 1, 4: 1}
    assert {r.doc_id for r in X.mixed_documents(docs, weights, least_epochs=2.0, max_epochs=3.0).collect()} == {1, 2, 3, 4}
    assert X.mixed_documents(docs, weights).where("doc_id > 1").count() == 0


def test_hot_source_and_unweighted(spark):
    docs = spark.range(900).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"),
                                   F.when(F.col("id") < 600, "hot").when(F.col("id") < 890, "cold").alias("source"))
    weights = spark.createDataFrame([("hot", 1.0), ("cold", 0.0), (None, 100.0)], "source string, weight double")
    plan = {r.source: (r.target, r.taken) for r in X.mix(docs, weights, budget_ratio=0.5).groupBy("row.source").agg(
        F.first("target").alias("target"), F.sum(F.col("size") * F.col("times")).alias("taken")).collect()}
    assert plan == {"hot": (1290.0, 1290), "cold": (0.0, 0), None: (60.0, 60)}


def test_edges(edge, empty):
    out = X.mixed_documents(edge, X.ranked_weights(edge, [5, 2, 1]), least_epochs=1.0)
    assert out.columns == edge.columns
    assert {r.row for r in out.distinct().collect()} == {"own row"} and out.count() >= edge.count()
    assert X.mix(empty, X.ranked_weights(empty, [1])).count() == 0
    none = X.mix(edge.where("doc_id in (2, 3)"), X.ranked_weights(edge, [1])).collect()
    assert [r.target for r in none] == [0.0, 0.0]
