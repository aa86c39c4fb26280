"""Sources and sinks: topic round trip, routed topics, upserts,
SQL-declared topic table, catalog DDL, word list, day partitions."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tidemill import sinks as K
from tidemill import sources as S

T0 = 1_704_067_200_000


def test_topic_round_trip_and_routing(spark, tmpdir_path):
    df = spark.createDataFrame([(1, "a", "t1"), (2, "b", "t2"), (3, None, "t1")], "id long, v string, tbl string")
    K.topic_sink(df, tmpdir_path, topic_col="tbl")                       # K3: per-row routing
    back = S.read_topic(spark, "t1", path=tmpdir_path, stream=False, fmt="json", schema="value string")
    vals = sorted(r["value"] for r in back.collect())
    assert vals == ['{"id":1,"v":"a"}', '{"id":3}']                       # nulls omitted, like the reference
    parts = {"even": df.where("id % 2 = 0").drop("tbl"), "odd": df.where("id % 2 = 1").drop("tbl")}
    K.write_routed(spark, parts, os.path.join(tmpdir_path, "routed"), source=df)
    odd = S.read_topic(spark, "odd", path=os.path.join(tmpdir_path, "routed"), stream=False, fmt="json",
                       schema="value string")
    assert odd.count() == 2


def test_upserts_replay_and_touch_their_partitions_only(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "ads")
    part = F.col("k") % 3
    put = lambda rows: sorted(tuple(r) for r in K.upsert_write(
        spark.createDataFrame(rows, "k long, s string, n long"), path, ["k"], ["s"], ["n"], part).drop("part").collect())
    put([(1, "x", 10), (2, "y", 20)])
    first = put([(2, "y2", 99), (3, "z", 30), (3, "older", 3)])
    assert first == [(1, "x", 10), (2, "y2", 20), (3, "z", 30)]                       # only s is updated, the latest row wins
    assert put([(2, "y2", 99), (3, "z", 30), (3, "older", 3)]) == first              # a replayed batch changes nothing
    files = {p: sorted(os.listdir(os.path.join(path, f"part={p}"))) for p in range(3)}
    assert put([(4, "new", 1)]) == [*first, (4, "new", 1)]
    assert [sorted(os.listdir(os.path.join(path, f"part={p}"))) == files[p] for p in range(3)] == [True, False, True]
    assert put([]) == [*first, (4, "new", 1)]
    with pytest.raises(ValueError):
        K.upsert_write(spark.createDataFrame([(1, "x")], "k long, s string"), path, ["k"], ["s"], [], part)


def test_upserts_of_a_stream(spark, tmpdir_path):
    """foreachBatch with the writer: several batches, one key in all of them."""
    from tidemill.streaming.jobs import start

    src, path = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "table")
    for k in range(3):
        spark.createDataFrame([(7, f"v{k}", k), (k, "own", k)], "k long, s string, n long").coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.05)
    stream = spark.readStream.schema("k long, s string, n long").option("maxFilesPerTrigger", 1).parquet(src)
    query = start(spark, stream, f"test/{os.path.basename(tmpdir_path)}", foreach_batch=lambda batch, _: K.upsert_write(
        batch, path, ["k"], ["s", "n"], ["n"], F.pmod("k", F.lit(2)).cast("int")) and None)
    assert query.awaitTermination(120)
    assert sorted(tuple(r)[:3] for r in spark.read.parquet(path).collect()) == [(0, "own", 0), (1, "own", 1), (2, "own", 2), (7, "v2", 2)]


def test_streaming_sinks(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    spark.createDataFrame([(1, "a", "t1"), (2, "b", "t2")], "skuId long, v string, tbl string").write.parquet(src)
    stream = lambda: spark.readStream.schema("skuId long, v string, tbl string").parquet(src)
    out = os.path.join(tmpdir_path, "topics")
    name = os.path.basename(tmpdir_path)
    assert K.topic_sink(stream(), out, topic_col="tbl", name=f"{name}/routed").awaitTermination(60)
    back = S.read_topic(spark, "t1", path=out, stream=False, fmt="json", schema="value string")
    assert [r["value"] for r in back.collect()] == ['{"skuId":1,"v":"a"}']
    olap = os.path.join(tmpdir_path, "olap")
    assert K.olap_load(stream(), olap, name=f"{name}/olap").awaitTermination(60)
    assert sorted(r["value"] for r in spark.read.text(olap).select("value").collect())[0] == '{"sku_id":1,"v":"a","tbl":"t1"}'
    assert K.console(stream(), name=f"{name}/console").awaitTermination(60)


def test_readers(spark, tmpdir_path, monkeypatch):
    path = os.path.join(tmpdir_path, "lines")
    spark.createDataFrame([(1, "a"), (2, None)], "id long, v string").write.json(path)
    assert sorted(tuple(r) for r in S.read_json_lines(spark, path, "id long, v string").collect()) == [(1, "a"), (2, None)]
    topic = os.path.join(tmpdir_path, "t")
    spark.createDataFrame([(1, "a"), (2, None)], "arrival long, value string").write.parquet(topic)
    assert S.read_topic(spark, topic, stream=False).count() == 1                     # a null payload is dropped
    assert S.read_topic(spark, topic, stream=False, null_safe=False).count() == 2
    asked = {}

    class Reader:
        def format(self, kind):
            return self

        def option(self, k, v):
            asked[k] = v
            return self

        def load(self):
            return spark.createDataFrame([(1,)], "sku_id long")

    class Session:
        read = Reader()

    S.read_jdbc(Session(), "jdbc:x", "select 1", partition_column="id", lower=0, upper=9, num_partitions=3)
    assert "query" not in asked and asked["dbtable"] == "(select 1) q" and asked["partitionColumn"] == "id"
    assert S.read_jdbc(Session(), "jdbc:x", "select 1", camel=True).columns == ["skuId"]


def test_topics_follow_their_input(spark, tmpdir_path):
    from tidemill.plans import adapters as AD
    src = os.path.join(tmpdir_path, "in")
    build = lambda s, d: AD.load(s, d, "events")
    spark.range(3).write.parquet(f"{src}/events.parquet")
    first = AD.topic_path(spark, src, "probe", build)
    assert AD.topic_path(spark, src, "probe", build) == first
    spark.range(5).write.mode("overwrite").parquet(f"{src}/events.parquet")
    second = AD.topic_path(spark, src, "probe", build)
    assert second != first and spark.read.parquet(second).count() == 5


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace
    from tidemill.session import checkpoint_dir
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        checkpoint_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=sc))


def test_topic_table_sql_and_catalog(spark, tmpdir_path):
    raw = spark.createDataFrame([('{"page": {"last_page_id": "search", "item_type": "keyword", "item": "Red Shoes"},'
                                  f' "ts": {T0}}}',)], "value string")
    S.topic_table(raw, "page map<string,string>, ts long", view="page_log")
    got = spark.sql("SELECT page['item'] AS item, date_format(et, 'yyyyMMdd') AS d FROM page_log "
                    "WHERE page['last_page_id'] = 'search' AND page['item_type'] = 'keyword'").collect()
    assert [(r["item"], r["d"]) for r in got] == [("Red Shoes", "20240101")]
    t = S.register_table(spark, "tm_dim", df=spark.createDataFrame([(1, "a")], "id long, name string"),
                         path=os.path.join(tmpdir_path, "tm_dim"))
    assert t.count() == 1 and "tm_dim" in [x.name for x in spark.catalog.listTables()]
    assert S.point_lookup(t, "id", 1).count() == 1 and S.row_count(t).first()[0] == 1
    assert S.scan_limit(t, 1, key="id").columns[0] == "row_key"


def test_word_list_and_day_partitions(spark, tmpdir_path):
    wl = os.path.join(tmpdir_path, "words.txt")
    with open(wl, "w", encoding="utf-8") as f:
        f.write("alpha\n beta \n\nalpha\n")
    assert sorted(r["word"] for r in S.read_word_list(spark, wl).collect()) == ["alpha", "beta"]
    ev = spark.createDataFrame([(1, T0), (2, T0 // 1000 + 86400), (3, None)], "id long, t long")
    out = os.path.join(tmpdir_path, "days")
    K.write_day_partitioned(ev, out, "t")
    assert sorted(d for d in os.listdir(out) if d.startswith("day=")) == [
        "day=20240101", "day=20240102", "day=error_bucket"]
    assert spark.read.parquet(out).where(F.col("day") == "20240102").count() == 1


def test_json_lines_snake_case(spark):
    df = spark.createDataFrame([(1, "x", None)], "skuId long, skuName string, tmName string")
    assert K.json_lines(df).first()["value"] == '{"sku_id":1,"sku_name":"x"}'


def test_days_are_packed_by_measured_bytes(spark, tmpdir_path):
    import glob

    path, out, target = os.path.join(tmpdir_path, "days"), os.path.join(tmpdir_path, "packed"), 200_000
    rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"),
                                      F.when(F.col("id") % 10 < 6, "20240101").when(F.col("id") % 10 < 9, "error_bucket").otherwise("20240103").alias("day"))
    rows.repartition(90, "id").write.partitionBy("day").parquet(path)
    spark.range(3).select("id", F.lit("lone").alias("v"), F.lit("20240104").alias("day")).coalesce(1).write.mode("append").partitionBy("day").parquet(path)
    sizes = lambda p: {d: sorted(map(os.path.getsize, glob.glob(f"{p}/day={d}/*.parquet"))) for d in ("20240101", "error_bucket", "20240103", "20240104")}
    before = sizes(path)
    key = lambda df: sorted(tuple(map(str, r)) for r in df.select("id", "v", "day").collect())
    got = K.pack_days(spark, path, out, target)
    assert key(got) == key(spark.read.parquet(path))
    after = sizes(out)
    for day, own in before.items():
        assert len(after[day]) <= sum(own) // target + 1 and max(after[day]) < target + max(own) + 4000
    assert len(before["20240101"]) == 90 and len(after["20240101"]) < 30 and len(after["20240104"]) == 1
