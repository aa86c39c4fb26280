"""Operators on hand-made rows (the cases listed in FIXTURES.md)."""

import json
import random

from pyspark.sql import functions as F

from tidemill import sinks as K
from tidemill.functions import keys as FK
from tidemill.functions import time as FT
from tidemill.functions.text import int_div, last_csv_token, safe_ratio
from tidemill.operators import dedup as D
from tidemill.operators import enrich as J
from tidemill.operators.keyed import keyed_is_last, keyed_lag, keyed_prefix_max
from tidemill.operators.parse import APP_LOG_SCHEMA, split_dirty, split_log, unpack_cdc
from tidemill.operators.topn import top_n

DAY = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC


def _key(t):
    return tuple((0, "") if x is None else (1, x) for x in t)  # nulls first, like Spark


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=_key)


# ---------------------------------------------------------------- P1 / P2
def test_split_dirty_and_log(spark):
    common = {"mid": "m1", "uid": "u1", "vc": "v", "ch": "c", "ar": "a", "is_new": "1"}
    page = {"page_id": "home", "last_page_id": None, "during_time": 5}
    recs = [
        (1, json.dumps({"common": common, "page": page, "err": {"code": "E1"}, "ts": T0})),          # err + page
        (2, json.dumps({"common": common, "start": {"entry": "icon"}, "err": {"code": "E2"}, "ts": T0})),  # err + start
        (3, json.dumps({"common": common, "start": {"entry": "icon"}, "ts": T0})),                  # start only
        (4, json.dumps({"common": common, "page": page, "displays": [], "ts": T0})),                 # empty array kept
        (5, json.dumps({"common": common, "page": page, "ts": T0})),                                 # missing arrays
        (6, json.dumps({"common": common, "page": page, "ts": T0,
                        "displays": [{"item": "1"}, {"item": "2"}],
                        "actions": [{"action_id": "a"}, {"action_id": "b"}]})),                       # 2 + 2
        (7, '{"common": {"mid": "m1"'),                                                              # broken
        (8, "[1, 2]"),                                                                               # not an object
    ]
    raw = spark.createDataFrame(recs, "arrival long, value string")
    parts = split_dirty(raw, APP_LOG_SCHEMA, keep=("arrival",))
    assert rows(parts["dirty"], "arrival") == [(7,), (8,)]
    s = split_log(parts["clean"], keep=("arrival",))
    assert rows(s["err"], "arrival") == [(1,), (2,)]
    assert rows(s["start"], "arrival") == [(2,), (3,)]
    assert "err" not in s["start"].columns
    assert rows(s["display"], "arrival", F.col("display")["item"]) == [(6, "1"), (6, "2")]
    assert rows(s["action"], "arrival", F.col("action")["action_id"]) == [(6, "a"), (6, "b")]
    assert "ts" not in s["action"].columns  # action rows carry no ts (ledger Q17)
    pg = {r["arrival"]: r for r in s["page"].collect()}
    assert sorted(pg) == [1, 4, 5, 6]
    assert pg[4]["displays"] == [] and pg[5]["displays"] is None
    assert pg[6]["displays"] is None and pg[6]["actions"] is None
    # P2 conserves rows: every clean record is either start or page
    assert s["start"].count() + s["page"].count() == parts["clean"].count()


def test_loose_records_are_clean(spark):
    """Repeated keys, a leading line break and numbers in quotes are valid; tabs are blank ids."""
    recs = [(1, '{"common": {"mid": "a", "mid": "b"}, "ts": 5}'), (2, '\n {"common": {"mid": "c"}, "ts": "5"}'),
            (3, '{"common": {"mid": "d"}, "ts": "x"}'), (4, None), (5, ""), (6, '"text"'), (7, '{"ts": 5} trailing')]
    parts = split_dirty(spark.createDataFrame(recs, "arrival long, value string"), keep=("arrival",))
    assert rows(parts["clean"].where("arrival < 4"), "arrival", "ts") == [(1, 5), (2, 5), (3, None)]
    assert {r["arrival"] for r in parts["dirty"].collect()} >= {4, 5, 6}
    from tidemill.functions.text import is_blank
    ids = spark.createDataFrame([("\t",), (" \n",), ("",), (None,), ("a\t",)], "v string")
    assert [r[0] for r in ids.select(is_blank("v")).collect()] == [True, True, True, True, False]


def test_unpack_cdc_ops(spark):
    env = spark.createDataFrame([
        (1, "r", None, {"id": "1"}, ("db", "t1", 0), 0),
        (2, "c", None, {"id": "2"}, ("db", "t1", 0), 0),
        (3, "u", {"id": "old"}, {"id": "3"}, ("db", "t2", 0), 0),
        (4, "d", {"id": "4"}, None, ("db", "t2", 0), 0),
        (5, "t", None, None, ("db", "t2", 0), 0),
    ], "arrival long, op string, before map<string,string>, after map<string,string>, "
       "source struct<db:string,table:string,ts_ms:long>, ts_ms long")
    out = unpack_cdc(env, keep=("arrival",))
    assert rows(out, "arrival", "op", "_table", F.col("data")["id"]) == [
        (1, "r", "t1", "1"), (2, "c", "t1", "2"), (3, "u", "t2", "3"), (4, "d", "t2", "4")]


# ---------------------------------------------------------------- D1 / D2 / D3 / D4 / D5
def test_retract_duplicates_net_sum(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("b", 2, 5.0), ("b", 3, 7.0), ("c", 4, 1.0), ("c", 5, 2.0),
                                ("c", 6, 4.0)], "id string, arrival long, amt double")
    out = D.retract_duplicates(df, ["id"], ["arrival"], ["amt"])
    assert out.count() == 6 + 3
    net = {r["id"]: r["s"] for r in out.groupBy("id").agg(F.sum("amt").alias("s")).collect()}
    assert net == {"a": 10.0, "b": 7.0, "c": 4.0}  # net = last record of each id
    assert rows(out.where("is_retract = 1"), "id", "arrival", "amt") == [("b", 2, -5.0), ("c", 4, -1.0), ("c", 5, -2.0)]


def test_keep_last_and_dedup_on_keys(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, "z")], "id string, arrival long, v string")
    assert rows(D.keep_last(df, ["id"], ["arrival"])) == [("a", 2, "y"), ("b", 3, "z")]
    assert rows(D.dedup_on_keys(df, ["id"], ["arrival"])) == [("a", 1, "x"), ("b", 3, "z")]
    dup = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y")], "k long, v string")
    assert rows(D.exact_dedup(dup)) == [(1, "x"), (1, "y")]


def test_monotone_latest(spark):
    df = spark.createDataFrame([(1, 1, 100), (1, 2, 200), (1, 3, 200), (1, 4, 150), (1, 5, 300), (2, 6, 50)],
                               "key long, arrival long, ts_ms long")
    for hot in (None, 2):
        out = D.monotone_latest(df, ["key"], ["arrival"], "ts_ms", hot_rows=hot)
        assert rows(out, "arrival") == [(1,), (2,), (5,), (6,)]  # equal and decreasing are dropped


# ---------------------------------------------------------------- D6 / D7 / D8 / D10
def test_repair_new_visitor(spark):
    df = spark.createDataFrame([
        ("m1", 1, T0, "1"), ("m1", 2, T0 + 3600_000, "1"), ("m1", 3, T0 + DAY, "1"),  # new on day 1 only
        ("m2", 4, T0, "0"), ("m2", 5, T0 + 60_000, "1"),                               # old device, is_new lost
    ], "mid string, arrival long, ts long, is_new string")
    out = D.repair_new_visitor(df, "mid", ["arrival"], "ts", "is_new", out="fixed")
    assert rows(out, "arrival", "fixed") == [(1, "1"), (2, "1"), (3, "0"), (4, "0"), (5, "0")]


def test_daily_unique_counts_out_of_order_twice(spark):
    df = spark.createDataFrame([("m", 1, T0), ("m", 2, T0 + 10), ("m", 3, T0 + DAY), ("m", 4, T0 + 5)],
                               "mid string, arrival long, ts long")
    out = D.daily_unique(df, ["mid"], ["arrival"], "ts", "uv")
    assert rows(out, "arrival", "uv") == [(1, 1), (2, 0), (3, 1), (4, 1)]  # ledger Q13


def test_daily_unique_pairs(spark):
    df = spark.createDataFrame([("m", "home", 1, T0), ("m", "good_detail", 2, T0), ("m", "home", 3, T0 + 1),
                                ("m", "cart", 4, T0)], "mid string, page_id string, arrival long, ts long")
    out = D.daily_unique_pairs(df, "mid", "page_id", ["arrival"], {"home": "h", "good_detail": "g"}, "ts")
    assert rows(out, "arrival", "h", "g") == [(1, 1, 0), (2, 0, 1)]


def test_daily_login_returning(spark):
    df = spark.createDataFrame([("u", 1, T0 + 5000), ("u", 2, T0 + 3 * DAY), ("u", 3, T0 + 11 * DAY + 1),
                                ("u", 4, T0 + 11 * DAY + 2)], "uid string, arrival long, ts long")
    out = D.daily_login(df, "uid", ["arrival"], "ts")
    assert rows(out, "arrival", "uu_ct", "back_ct") == [(1, 1, 0), (2, 1, 0), (3, 1, 1)]


def test_first_seen_and_visitor_split(spark):
    from tidemill.plans.traffic import flag_new_visitors, visitor_split
    df = spark.createDataFrame([(1, {"visitor_id": "v1", "is_new_visitor": "9"}), (2, {"visitor_id": "v2"}),
                                (3, {"visitor_id": "v1", "is_new_visitor": "9"}), (4, {"x": "y"})],
                               "arrival long, data map<string,string>").withColumn("op", F.lit("c")).withColumn("_table", F.lit("t"))
    flag = lambda only: sorted((r.arrival, (r["data"] or {}).get("is_new_visitor"))
                               for r in flag_new_visitors(df, only).collect())
    assert flag(True) == [(1, "1"), (2, None), (3, "0"), (4, None)]
    assert flag(False) == [(1, "1"), (2, "1"), (3, "0"), (4, None)]
    assert rows(visitor_split(df), "arrival", "stream") == [(1, "new"), (2, "new"), (3, "old")]


# ---------------------------------------------------------------- skew-safe primitives
def test_split_hot_keys_equal_plain_windows(spark):
    rnd = random.Random(7)
    data = [(rnd.choice(["hot", "hot", "hot", "a", "b", None]), i, rnd.randint(0, 50)) for i in range(400)]
    df = spark.createDataFrame(data, "k string, arrival long, v long")
    assert rows(keyed_lag(df, ["k"], ["arrival"], ["v"])) == rows(keyed_lag(df, ["k"], ["arrival"], ["v"], hot_rows=30))
    assert rows(keyed_prefix_max(df, ["k"], ["arrival"], "v")) == rows(keyed_prefix_max(df, ["k"], ["arrival"], "v", hot_rows=30))
    assert rows(keyed_is_last(df, ["k"], ["arrival"])) == rows(keyed_is_last(df, ["k"], ["arrival"], hot_rows=30))


def test_keys_are_not_counted_one_by_one_without_need(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from tidemill.operators import keyed as K
    asked, group = [], DataFrame.groupBy
    monkeypatch.setattr(DataFrame, "groupBy", lambda self, *c: asked.append(c) or group(self, *c))
    df = spark.range(300).select(F.col("id").cast("string").alias("k"), F.col("id").alias("arrival"))
    assert K._split_hot(df, ["k"], K.arrival_number(df, "arrival"), 100)[1] is None
    assert len(asked) == 1 and "__bucket" in str(asked[0][0])
    monkeypatch.setattr(K, "BUCKETS", 2)  # buckets over the limit, but no key
    assert K._split_hot(df, ["k"], K.arrival_number(df, "arrival"), 100)[1] is None


def test_tables_are_dealt_by_rows(spark):
    from tidemill.operators.keyed import dealt
    df = spark.range(9000)
    assert dealt(df, 9000, ["id"], most=2000) is df
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dealt(df, 9000, ["id"], most=1000).rdd.getNumPartitions() == max(9, least)
    assert dealt(df, 9000, ["id"], most=10).rdd.getNumPartitions() == max(900, least)


def test_records_without_a_visitor_do_not_meet_in_one_task(spark):
    from tidemill.plans.traffic import first_seen
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(2000).select(F.col("id").alias("arrival"), F.when(F.col("id") % 2 == 0, F.create_map(F.lit("x"), F.lit("y"))).otherwise(
            F.create_map(F.lit("visitor_id"), F.col("id").cast("string"))).alias("data"))
        seen = first_seen(df).groupBy(F.spark_partition_id().alias("p"), F.col("__vid").isNull().alias("none")).count().collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    nulls = [r["count"] for r in seen if r["none"]]
    assert sum(nulls) == 1000 and max(nulls) <= 800


def test_a_hot_key_is_dealt_to_many_tasks(spark):
    """A key with a third of the rows: no window partition holds more than its share."""
    from tidemill.operators import keyed as K
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                  F.col("id").alias("arrival"))
    cold, hot = K._split_hot(df, ["k"], K.arrival_number(df, "arrival"), 100)
    assert cold.where("k = 'hot'").count() == 0 and cold.count() + hot.count() == 3000
    assert hot.groupBy("k", "__seg").count().agg(F.max("count")).first()[0] <= 101


def test_retract_on_ties_and_two_partitions(spark):
    same = spark.createDataFrame([("x", 1, 10.0), ("x", 1, 10.0)], "id string, arrival long, amt double")
    out = D.retract_duplicates(same, ["id"], ["arrival"], ["amt"])
    assert out.agg(F.sum("amt")).first()[0] == 10.0 and out.count() == 3
    from tidemill.sources import kafka_records
    raw = spark.createDataFrame([(1, 0, 5, b"a"), (1, 1, 5, b"b"), (0, 1, 9, b"c")], "t long, partition int, offset long, value binary")
    topic = kafka_records(raw.withColumn("timestamp", F.timestamp_seconds("t")).drop("t"))
    assert [r["value"] for r in topic.orderBy("arrival").collect()] == ["c", "a", "b"]
    first = D.daily_unique(topic.withColumn("mid", F.lit("m")).withColumn("ts", F.lit(0).cast("long")), ["mid"], ["arrival"])
    assert first.agg(F.sum("uv_ct")).first()[0] == 1


def test_top_n(spark):
    rnd = random.Random(3)
    data = [(rnd.choice(["g1", "g2"]), i, rnd.randint(0, 9)) for i in range(300)]
    got = top_n(spark.createDataFrame(data, "g string, id long, score long"), ["g"], [F.col("score").desc(), F.col("id").asc()], 5)
    want = [(g, i, s, k + 1) for g in ("g1", "g2")
            for k, (_, i, s) in enumerate(sorted((x for x in data if x[0] == g), key=lambda x: (-x[2], x[1]))[:5])]
    assert rows(got, "g", "id", "score", "ranking") == sorted(want)


# ---------------------------------------------------------------- joins
def test_interval_join_matches_brute_force(spark):
    rnd = random.Random(11)
    left = spark.createDataFrame([(i, rnd.randint(0, 3), rnd.randint(0, 10_000)) for i in range(200)],
                                 "id long, user long, t long")
    right = spark.createDataFrame([(i, rnd.randint(0, 3), rnd.randint(0, 10_000)) for i in range(200)],
                                  "id long, user long, t long")
    got = J.interval_join(left, right, "user", "t", "t", 300, 500)
    brute = left.crossJoin(right.select(*[F.col(c).alias("info_" + c) for c in right.columns])).where(
        (F.col("user") == F.col("info_user")) & F.col("info_t").between(F.col("t") - 300, F.col("t") + 500))
    cols = ["id", "info_id"]
    assert rows(got, *cols) == rows(brute, *cols)


def test_word_check_comma_cases(spark):
    words = spark.createDataFrame([("bad",), ("b",)], "word string")
    c = spark.createDataFrame([(1, "a,b"), (2, "a,b,,"), (3, ","), (4, ""), (5, "x,bad"), (6, "x,good"), (7, None)],
                              "id long, txt string")
    out = J.word_check(c, words, "txt")
    assert rows(out, "id", "is_violation", "violation_msg") == [
        (1, 1, "b"), (2, 1, "b"), (3, 0, None), (4, 0, None), (5, 1, "bad"), (6, 0, None), (7, 0, None)]
    toks = {r["id"]: r["t"] for r in c.select("id", last_csv_token("txt").alias("t")).collect()}
    assert toks[1] == "b" and toks[2] == "b" and toks[3] == ""  # ledger Q19


def test_dict_lookup_and_chain(spark):
    facts = spark.createDataFrame([(1, "x"), (2, "y")], "id long, code string")
    dic = spark.createDataFrame([("x", "X name")], "k string, name string")
    assert rows(J.dict_lookup(facts, dic, "code", "k", "name", "dic_name"), "id", "dic_name") == [
        (1, "X name"), (2, "N/A")]
    d1 = spark.createDataFrame([("x", "p1")], "id string, parent string")
    d2 = spark.createDataFrame([("p1", "P one")], "id string, pname string")
    out = J.snowflake_chain(facts, [("code", d1, "id", {"parent": "parent"}), ("parent", d2, "id", {"pname": "pname"})])
    assert rows(out, "id", "parent", "pname") == [(1, "p1", "P one"), (2, None, None)]


# ---------------------------------------------------------------- upserts
def test_latest_non_null_keeps_old_value(spark):
    ch = spark.createDataFrame([(1, 1, "r", "a", 10), (1, 2, "u", None, 20), (1, 3, "d", "zz", 99), (2, 4, "c", "b", None)],
                               "k long, seq long, op string, name string, n long")
    out = K.dim_upsert(None, ch, "k", ["name", "n"], "seq")
    assert rows(out) == [(1, "a", 20), (2, "b", None)]
    cur = spark.createDataFrame([(2, "old", 7), (3, "keep", 1)], "k long, name string, n long")
    assert rows(K.dim_upsert(cur, ch, "k", ["name", "n"], "seq")) == [(1, "a", 20), (2, "b", 7), (3, "keep", 1)]


def test_upsert_merge_updates_listed_columns_only(spark):
    cur = spark.createDataFrame([(1, "old", 1.0), (2, "old", 2.0)], "k long, status string, price double")
    new = spark.createDataFrame([(2, "new", 9.0, 1), (2, "newer", 8.0, 2), (3, "ins", 3.0, 1)],
                                "k long, status string, price double, seq long")
    out = K.upsert_merge(cur, new, ["k"], ["status"], order=["seq"])
    assert rows(out, "k", "status", "price") == [(1, "old", 1.0), (2, "newer", 2.0), (3, "ins", 3.0)]


def test_delete_keys_and_day_partition(spark):
    cur = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    assert rows(K.delete_keys(cur, spark.createDataFrame([(2,)], "k long"), ["k"])) == [(1,), (3,)]
    t = spark.createDataFrame([(1, T0 // 1000), (2, T0 + DAY), (3, None)], "id long, t long")
    assert rows(K.day_partition(t, "t"), "id", "day") == [(1, "20240101"), (2, "20240102"), (3, "error_bucket")]


# ---------------------------------------------------------------- column functions
def test_column_functions(spark):
    r = spark.range(1).select(
        FK.md5_key(F.lit("6")).alias("md5"),
        FK.hash_bucket(F.lit("abc"), 128).alias("bucket"),
        FK.hash_bucket(F.lit("HOT"), 128, {"hot": 7}).alias("hot"),
        FT.datetime_str_to_ms(F.lit("2024-01-01 08:00:00"), "+08:00").alias("f3"),
        FT.ms_to_datetime_str(F.lit(T0 + 3_723_000)).alias("f2"),
        FT.stat_hour_ms(F.lit(T0 + 3_723_000)).alias("f5"),
        FT.day_list(F.lit("2024-01-30"), F.lit("2024-02-02")).alias("f15"),
        FT.to_millis(F.lit(T0 // 1000)).alias("f22"),
        FT.days_since_date(F.lit(T0 + 8 * DAY + 5), F.lit("2024-01-01")).alias("f24"),
        safe_ratio(F.lit(1), F.lit(0)).alias("r0"), int_div(F.lit(7), F.lit(2)).alias("idiv"),
        FT.json_time_field(F.lit('{"t": "12"}'), "t").alias("w3"), FT.json_time_field(F.lit("{}"), "t").alias("w3b"),
    ).first()
    assert r["md5"] == "1679091c5a880faf6fb5e6087eb1b2dc"
    assert r["bucket"] == "0114" and r["hot"] == "0007"
    assert r["f3"] == T0 and r["f2"] == "2024-01-01 01:02:03" and r["f5"] == T0 + 3_600_000
    assert r["f15"] == [20240130, 20240131, 20240201, 20240202]
    assert r["f22"] == T0 and r["f24"] == 8 and r["r0"] == 0.0 and r["idiv"] == 3
    assert r["w3"] == 12_000 and r["w3b"] == 0
    assert FK.snake_to_camel("sku_order_id") == "skuOrderId" and FK.camel_to_snake("skuOrderId") == "sku_order_id"


def test_keyword_udtf_lateral(spark):
    from tidemill.operators.keywords import register_keyword_udtf
    register_keyword_udtf(spark)
    spark.createDataFrame([(1, "Élan, vité! Zwei 2x")], "id long, t string").createOrReplaceTempView("kw_src")
    got = rows(spark.sql("SELECT id, word FROM kw_src, LATERAL keyword_udtf(t)"))
    assert got == sorted([(1, "élan"), (1, "vité"), (1, "zwei"), (1, "2x")])


def test_hot_key_bound_does_not_change_query_results(spark):
    """The hot-key split is exact: a tiny bound gives the same answer."""
    from tidemill.plans import queries as Q
    from table_paths import SF_SMALL
    base = rows(Q.QUERIES["login_return_users"](spark, SF_SMALL))
    spark.conf.set("spark.tidemill.hotRows", "3")
    try:
        tiny = rows(Q.QUERIES["login_return_users"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.tidemill.hotRows")
    assert base == tiny and len(base) > 0
