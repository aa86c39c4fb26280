import zlib

from pyspark.sql import functions as F

from tidemill.llm import sharding as S
from tidemill.llm.weighted import weighted_cuts

SF = "/root/testdata/sf0.01"


def test_shards_are_even_and_numbered(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = S.kd_shards(docs, 40).toPandas()
    assert len(rows) == len(texts) and rows["doc_id"].is_unique
    for r in rows.itertuples():
        raw = texts[r.doc_id].encode()
        assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)
    sizes = rows.groupby("shard")["size"].sum()
    assert sorted(sizes.index) == list(range(40)) and sizes.max() - sizes.min() <= rows["size"].max()
    for _, g in rows.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))


def test_groups_stay_whole_unless_large(spark):
    rows = [(i, f"text {i % 300} " * 5, "en", f"s{i % 7}") for i in range(900)] + [(1000 + i, "hot " * 9, "en", "s1") for i in range(900)]
    shards = S.kd_shards(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), 6).toPandas()
    sizes = shards.groupby("shard")["size"].sum()
    assert sizes.max() / sizes.min() < 1.02
    assert (shards.groupby("text_crc32")["shard"].nunique() > 1).sum() <= 5 + 1


def test_weighted_cuts(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("g"), (F.col("id") * 2**40).alias("code"), F.lit(3).cast("long").alias("w"))
    targets = spark.createDataFrame([(0, 300.0, 0.0), (1, 1e9, 0.0)], "g long, target double, tolerance double")
    cuts = {r.g: r.cut_code for r in weighted_cuts(rows, targets).collect()}
    left = rows.collect()
    assert sum(r.w for r in left if r.g == 0 and r.code < cuts[0]) == 300
    assert all(r.code < cuts[1] for r in left if r.g == 1)


def test_edges(edge, empty):
    out = S.kd_shards(edge, 3).toPandas()
    assert len(out) == edge.count() and (out["size"] >= 16).all() and set(out["shard"]) <= {0, 1, 2}
    for _, g in out.groupby("shard"):
        assert sorted(g["slot"]) == list(range(len(g)))
    assert S.kd_shards(empty, 4).count() == 0 and S.kd_shards(edge, 1).where("shard <> 0").count() == 0
