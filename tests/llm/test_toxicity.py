from pyspark.sql import functions as F

from tidemill.llm import toxicity as X
from tidemill.llm.common import table

SF = "/root/testdata/sf0.01"


def test_features_find_disguised_words_and_second_person():
    lexicon = X._automaton({"idiot": 5.0, "lowei*": 4.0})
    f = {n: i for i, n in enumerate(X.FEATURES)}
    plain, none, disguised, stem, inside = X.dense_features(
        ["you are an idiot", "a fine day", "such an 1d!ot id1ot", "die loweischaft", "the videoidiotic word"], lexicon)
    assert plain[f["_tox_hits"]] > 0 and plain[f["_tox_person"]] > 0.5 and none[f["_tox_hits"]] == 0
    assert disguised[f["_tox_hits"]] > 0 and disguised[f["_tox_obfuscated"]] > 0
    assert stem[f["_tox_top"]] == 4.0 and inside[f["_tox_hits"]] == 0


def test_features_find_runs_of_symbols():
    """Words whose only disguises are several symbols in a row, also at the ends of the batch."""
    lexicon = X._automaton({"asshole": 5.0, "shiit": 4.0})
    f = {n: i for i, n in enumerate(X.FEATURES)}
    one, two, none, ends = X.dense_features(["what an a$$hole", "this is sh!!t", "it costs 100 $$ or so!! yes", "$$a!!"], lexicon)
    assert one[f["_tox_top"]] == 5.0 and two[f["_tox_top"]] == 4.0
    assert one[f["_tox_obfuscated"]] == 2 / 15 and two[f["_tox_obfuscated"]] == 2 / 13
    assert none[f["_tox_obfuscated"]] == ends[f["_tox_obfuscated"]] == 0


def test_held_out_accuracy(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    model = X.fit(docs.select("doc_id", "text"), labels, ~X.held_out("doc_id"))
    rows = (model.score(docs.select("doc_id", "text")).select("row.doc_id", "score").join(labels, "doc_id")
            .where(X.held_out("doc_id")).toPandas())
    flagged = rows["score"] >= 0.3
    assert rows["score"].between(0, 1).all()
    assert (flagged & (rows["toxic"] == 1)).sum() / (rows["toxic"] == 1).sum() > 0.9
    assert (flagged & (rows["toxic"] == 1)).sum() / flagged.sum() > 0.9


def test_folds_that_lack_a_kind_of_label(spark):
    """All toxic rows in the folds that are fitted, or all in the one that calibrates."""
    ids = spark.range(600).select(F.col("id").alias("doc_id"), F.pmod(F.xxhash64("id", F.lit(12)), F.lit(X.FOLDS)).alias("fold"))
    fold = {r.doc_id: r.fold for r in ids.collect()}
    for last in (False, True):
        toxic = [i for i in fold if (fold[i] == X.FOLDS - 1) == last][:40]
        rows = [(i, "you stupid moron, get lost" if i in toxic else f"a fine day in town number {i}", int(i in toxic)) for i in fold]
        df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
        scored = X.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic")).score(df).select("row.toxic", "score").collect()
        assert min(r.score for r in scored if r.toxic) >= 0.3 > max(r.score for r in scored if not r.toxic)


def test_edges(spark, edge, empty):
    labels = table(spark, SF, "labels")
    docs = table(spark, SF, "documents")
    model = X.fit(docs, labels)
    scored = model.score(edge)
    rows = scored.select("row.doc_id", "score").collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    assert model.score(empty).count() == 0
    assert X.drop_toxic(edge, labels).columns == edge.columns
    none = X.fit(docs, labels.limit(0))
    assert none.score(edge).where("score <> 0").count() == 0
    one = X.fit(docs, labels.withColumn("toxic", F.lit(None).cast("int")))
    assert one.score(edge).count() == edge.count()
