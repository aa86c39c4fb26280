"""Registered queries that write tables and topics and read them back, and the source, key and
time functions that no other query uses.  Everything is written under the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import sinks as K
from .. import sources as S
from ..functions import keys as FK
from ..functions import time as FT
from ..operators.parse import unpack_cdc
from ..session import checkpoint_dir, shuffle_partitions_for
from ..sources.handover import change_source
from . import adapters as AD
from . import queries as Q


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/written/{name}-{uuid.uuid4().hex[:12]}"


# U4 + F7 + F8: which source table feeds which dimension, and its row key (fixed values).
DIM_CONFIG = [("ods_user_visit_log", "dim_visit", "visitor_id,log_id"), ("ods_page_click_log", "dim_click", "log_id"),
              ("ods_crowd_attribute_log", "dim_crowd", "visitor_id")]


@Q.register("dim_config_route", f"""
WITH o AS (SELECT * FROM {AD.SQL("ods")} x WHERE op IN ('r', 'c', 'u'))
SELECT event_id AS arrival, 'dim_visit' AS sink_table, md5(visitor_id || '_' || log_id) AS row_key, visitor_id,
       coalesce(traffic_source_first, 'null') AS shown FROM o WHERE tbl = 'ods_user_visit_log'
UNION ALL
SELECT event_id, 'dim_click', md5(log_id), visitor_id, coalesce(guide_product_id, 'null') FROM o WHERE tbl = 'ods_page_click_log'
UNION ALL
SELECT event_id, 'dim_crowd', md5(visitor_id), visitor_id, coalesce(city, 'null') FROM o WHERE tbl = 'ods_crowd_attribute_log'
""")
def q_dim_config_route(spark, sf_dir):
    config = spark.createDataFrame(DIM_CONFIG, "source_table string, sink_table string, row_key string")
    routed = K.dim_config_route(unpack_cdc(Q.envelopes(spark, sf_dir), keep=("arrival",)), config)
    d = F.col("data")
    shown = F.coalesce(d["traffic_source_first"], d["guide_product_id"], d["city"])
    return routed.select("arrival", "sink_table", "row_key", d["visitor_id"].alias("visitor_id"), shown.alias("shown"))


# S3: orders change while a snapshot of them is read in chunks of 500 keys.  Every order is created,
# updated, and one in five deleted; a chunk's marks are 400 positions apart, the rows are those of some
# position between them.  SQL tells the table at each chunk's high mark from the log alone.
_VERSIONS = {
    "chunk": "CAST(floor(o_orderkey / 500) AS BIGINT)",
    "made": "CAST(o_custkey * 37 % 3000 AS BIGINT)",
    "changed": "CAST(o_custkey * 37 % 3000 + 1 + o_orderkey * 13 % 900 AS BIGINT)",
    "gone": "CASE WHEN o_orderkey % 5 = 0 THEN CAST(o_custkey * 37 % 3000 + 901 + o_orderkey * 7 % 700 AS BIGINT) END",
}
_LOW, _READ, _HIGH = ("chunk * 97 % 2600", "chunk * 97 % 2600 + 1 + o_orderkey % 399", "chunk * 97 % 2600 + 400")
_VERSIONED = "SELECT o_orderkey, o_orderstatus, " + ", ".join(f"{e} AS {n}" for n, e in _VERSIONS.items())


def _order_versions(spark, sf_dir):
    o = AD.load(spark, sf_dir, "orders").dropDuplicates(["o_orderkey"])
    return o.selectExpr("o_orderkey", "o_orderstatus", *[f"{e} AS {n}" for n, e in _VERSIONS.items()])


def _order_log(versions):
    image = lambda version: F.create_map(F.lit("status"), F.lit(version))
    change = lambda at, op, before, after: F.struct(F.col(at).alias("position"), F.lit(op).alias("op"),
                                                    before.alias("before"), after.alias("after"))
    none = F.lit(None).cast("map<string,string>")
    changes = F.array(change("made", "c", none, image("new")), change("changed", "u", image("new"), image("paid")),
                      change("gone", "d", image("paid"), none))
    return versions.select("o_orderkey", "chunk", F.explode(changes).alias("e")).select("o_orderkey", "chunk", "e.*").where("position is not null")


@Q.register("cdc_snapshot_then_log", f"""
WITH v AS (SELECT *, {_HIGH} AS high FROM ({_VERSIONED} FROM (SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus FROM orders) o) x)
SELECT o_orderkey, high AS "position", 'r' AS op, CASE WHEN changed <= high THEN 'paid' ELSE 'new' END AS status FROM v
WHERE made <= high AND (gone IS NULL OR gone > high)
UNION ALL SELECT o_orderkey, made, 'c', 'new' FROM v WHERE made > high
UNION ALL SELECT o_orderkey, changed, 'u', 'paid' FROM v WHERE changed > high
UNION ALL SELECT o_orderkey, gone, 'd', 'paid' FROM v WHERE gone > high
""")
def q_cdc_snapshot_then_log(spark, sf_dir):
    versions = _order_versions(spark, sf_dir)
    marks = versions.select("chunk").distinct().selectExpr("chunk", f"{_LOW} AS low", f"{_HIGH} AS high")
    read = versions.selectExpr("*", f"{_READ} AS seen").where("made <= seen and (gone is null or gone > seen)")
    status = F.when(F.col("changed") <= F.col("seen"), "paid").otherwise("new")
    snapshot = read.select("o_orderkey", "chunk", F.create_map(F.lit("status"), status).alias("after"))
    told = change_source("initial", _order_log(versions), ["o_orderkey"], snapshot, marks)
    return told.select("o_orderkey", "position", "op", F.coalesce(F.col("after")["status"], F.col("before")["status"]).alias("status"))


# U4 with a config that changes: at the middle of its log a table moves to another sink table and row
# key, one loses its mapping, one gets it only then.  Changes of the config are derived from the log.
_LATE, _DROPPED = "ods_order_pay_log", "ods_search_log"


def _config_changes(spark, sf_dir):
    log = AD.ods_fields(AD.load(spark, sf_dir, "events")).groupBy("tbl").agg(F.min("event_id").alias("lo"), F.max("event_id").alias("hi"))
    first = log.where(F.col("tbl") != _LATE).select(F.col("lo").alias("arrival"), F.lit("r").alias("op"), F.col("tbl").alias("source_table"),
                                                    F.concat(F.lit("dim_"), "tbl").alias("sink_table"), F.lit("log_id").alias("row_key"))
    gone = F.col("tbl") == _DROPPED
    later = log.select(F.floor((F.col("lo") + F.col("hi")) / 2).cast("long").alias("arrival"), F.when(gone, "d").otherwise("u").alias("op"),
                       F.col("tbl").alias("source_table"), F.when(~gone, F.concat(F.lit("dim2_"), "tbl")).alias("sink_table"),
                       F.when(~gone, F.lit("log_id, terminal_type")).alias("row_key"))
    return first.unionByName(later)


_ROUTED_AS_OF = f"""
WITH o AS (SELECT * FROM {AD.SQL("ods")} x),
m AS (SELECT tbl, (min(event_id) + max(event_id)) // 2 AS mid FROM o GROUP BY tbl)
SELECT event_id AS arrival, CASE WHEN event_id >= mid THEN 'dim2_' ELSE 'dim_' END || tbl AS sink_table,
       md5(CASE WHEN event_id < mid THEN log_id WHEN tbl = 'ods_crowd_attribute_log' THEN log_id || '_null'
                ELSE log_id || '_' || terminal_type END) AS row_key, log_id
FROM o JOIN m USING (tbl)
WHERE op IN ('r', 'c', 'u') AND CASE tbl WHEN '{_LATE}' THEN event_id >= mid WHEN '{_DROPPED}' THEN event_id < mid ELSE true END
"""


@Q.register("dim_config_route_as_of", _ROUTED_AS_OF)
def q_dim_config_route_as_of(spark, sf_dir):
    unpacked = unpack_cdc(Q.envelopes(spark, sf_dir), keep=("arrival",))
    routed = K.dim_config_route_as_of(unpacked, _config_changes(spark, sf_dir))
    return routed.select("arrival", "sink_table", "row_key", F.col("data")["log_id"].alias("log_id"))


# K5: batches that insert and update, two of them replayed; partitions as many as the table's bytes ask for.
_ORDERS = "(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders)"


def _upserts(spark, sf_dir, repeat: bool):
    path = _folder(spark, "orders")
    o = AD.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    second = o.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("U")).withColumn("o_totalprice", F.lit(0.0))
    third = o.where("o_orderkey % 3 = 1").withColumn("o_orderstatus", F.lit("V"))
    part = F.pmod(F.xxhash64("o_orderkey"), F.lit(shuffle_partitions_for(spark, f"{sf_dir.rstrip('/')}/orders.parquet", least=4))).cast("int")
    put = lambda batch: K.upsert_write(batch, path, ["o_orderkey"], ["o_orderstatus"], ["o_totalprice"], part)
    put(o.where("o_orderkey % 3 < 2"))
    put(o.where("o_orderkey % 3 >= 0").withColumn("o_orderstatus", F.lit("T")))
    table = put(second)
    if repeat:
        put(second)
        put(third)
        table = put(third)
    return table.drop("part")


@Q.register("upsert_two_batches", f"""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'U' ELSE 'T' END AS o_orderstatus, o_totalprice FROM {_ORDERS} o
""")
def q_upsert_two_batches(spark, sf_dir):
    return _upserts(spark, sf_dir, repeat=False)


@Q.register("upsert_replay", f"""
SELECT o_orderkey, o_custkey, CASE o_orderkey % 3 WHEN 0 THEN 'U' WHEN 1 THEN 'V' ELSE 'T' END AS o_orderstatus, o_totalprice
FROM {_ORDERS} o
""")
def q_upsert_replay(spark, sf_dir):
    return _upserts(spark, sf_dir, repeat=True)


# K1 + K3 + S1 + S2: routed records, read back topic by topic; records without payload are dropped.
@Q.register("topic_routed_roundtrip", f"SELECT event_id, event_type AS topic, user_id FROM {AD.SQL('base')} b")
def q_topic_routed_roundtrip(spark, sf_dir):
    path = _folder(spark, "topics")
    events = Q._events(spark, sf_dir).select("event_id", "user_id", "event_type")
    K.topic_sink(events, path, topic_col="event_type")
    names = [r[0] for r in events.select("event_type").distinct().collect()]  # topics: a handful
    parts = [S.read_topic(spark, t, path=path, stream=False, fmt="json", schema="value string").select(
        F.from_json("value", "event_id long, user_id long").alias("r"), F.lit(t).alias("topic")) for t in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.select("r.event_id", "topic", "r.user_id")


# The same as a stream: K1/K3 streaming sink and S1 streaming source.
@Q.register("stream_topic_roundtrip", Q.ORACLE["topic_routed_roundtrip"])
def q_stream_topic_roundtrip(spark, sf_dir):
    source = AD.topic_path(spark, sf_dir, "event_kinds", lambda s, d: Q._events(s, d).select("event_id", "user_id", "event_type"))
    path = _folder(spark, "stream-topics")
    rows = spark.readStream.schema("event_id long, user_id long, event_type string").parquet(source)
    K.topic_sink(rows, path, topic_col="event_type", name=f"roundtrip/{uuid.uuid4().hex[:12]}").awaitTermination()
    back = spark.read.schema("value string, topic string").json(path)
    return back.select(F.from_json("value", "event_id long, user_id long").alias("r"), "topic").select("r.event_id", "topic", "r.user_id")


@Q.register("day_partition_written", Q.ORACLE["day_partition_sink"])
def q_day_partition_written(spark, sf_dir):
    path = _folder(spark, "days")
    e = Q._events(spark, sf_dir).selectExpr("event_id", f"{Q._K6_T.replace('//', 'div')} AS t")
    K.write_day_partitioned(e, path, "t")
    return spark.read.schema("event_id long, t long, day string").parquet(path)


# K6 rolled by size: many small files a day are packed by their measured bytes.
@Q.register("day_partition_packed", Q.ORACLE["day_partition_sink"])
def q_day_partition_packed(spark, sf_dir):
    path = _folder(spark, "days")
    e = Q._events(spark, sf_dir).selectExpr("event_id", f"{Q._K6_T.replace('//', 'div')} AS t")
    K.write_day_partitioned(e, path, "t")
    return K.pack_days(spark, path, f"{path}-packed").select("event_id", "t", F.col("day").cast("string").alias("day"))


# K4 written and S7 read back: window beans as JSON lines.
@Q.register("olap_load_roundtrip", Q.ORACLE["page_view_window"])
def q_olap_load_roundtrip(spark, sf_dir):
    path = _folder(spark, "olap")
    beans = FK.rename_columns(Q.q_page_view_window(spark, sf_dir), "camel")
    K.olap_load(beans, path)
    schema = ", ".join(f"{c} {'long' if c.endswith('_ct') or c == 'dur_sum' else 'string'}" for c in Q._PV_COLS)
    return S.read_json_lines(spark, path, schema)


# S8 + T5: the first rows of a keyed table (a limit is the feature); its keys are those of the table.
@Q.register("scan_limit_keys", "SELECT least(100, count(*))::BIGINT AS n_rows, 0::BIGINT AS n_unknown FROM customer")
def q_scan_limit_keys(spark, sf_dir):
    customers = AD.load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    first = S.scan_limit(customers, 100, key="c_custkey")
    known = customers.select(F.col("c_custkey").alias("row_key"), F.lit(1).alias("known"))
    return first.join(known, "row_key", "left").agg(F.count("*").alias("n_rows"),
                                                    F.count(F.when(F.col("known").isNull(), 1)).alias("n_unknown"))


# A point lookup of each nation's row by key.
@Q.register("point_lookup_nation", "SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey = 7")
def q_point_lookup_nation(spark, sf_dir):
    return S.point_lookup(AD.load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), "n_nationkey", 7)


# A word list in text lines, one word a line, blanks and repetitions removed.
@Q.register("word_list_lines", f"SELECT DISTINCT w AS word FROM (SELECT unnest(string_split_regex(lower(text), '{Q._SPLIT}')) AS w "
                               "FROM benchmark) t WHERE w <> ''")
def q_word_list_lines(spark, sf_dir):
    path = _folder(spark, "words")
    words = AD.load(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), Q._SPLIT)).alias("w"))
    words.select(F.concat(F.lit(" "), "w").alias("value")).write.text(path)
    return S.read_word_list(spark, path)


# Catalog DDL round trip.
@Q.register("catalog_table", "SELECT r_regionkey, r_name FROM region")
def q_catalog_table(spark, sf_dir):
    name = f"tidemill_region_{uuid.uuid4().hex[:8]}"
    region = AD.load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return S.register_table(spark, name, df=region, path=_folder(spark, "region"))


# Time and key functions on every event.
_JSON = ("'{\"block_timestamp\": ' || (ts_ms // 1000) || ', \"timestamp\": ' || (ts_ms // 1000 + k) || '}'",
         "'{\"timestamp\": ' || (ts_ms // 1000 + k) || '}'")


@Q.register("time_key_functions", f"""
SELECT event_id, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S') AS at, strftime(make_timestamp(ts_ms * 1000), '%Y/%m/%d') AS shown,
       md5(CAST(user_id AS VARCHAR)) AS user_md5, md5(CAST(user_id AS VARCHAR) || '_' || event_type) AS row_key,
       md5(CAST(user_id AS VARCHAR)) || '_' || md5(event_type) AS parts_key,
       (ts_ms // 1000) * 1000 AS json_time, CASE WHEN k % 2 = 0 THEN (ts_ms // 1000) * 1000 ELSE (ts_ms // 1000 + k) * 1000 END AS first_time,
       ts_ms AS head_time, CAST(k % 4 + 1 AS BIGINT) AS n_days
FROM {AD.SQL('base')} b
""")
def q_time_key_functions(spark, sf_dir):
    e = Q._events(spark, sf_dir)
    both, one = (F.expr(x.replace("//", "div").replace('"', '\\"')) for x in _JSON)
    first = F.when(F.col("k") % 2 == 0, both).otherwise(one)
    head = F.array(F.struct(F.col("ts_ms").alias("window_start_time")), F.struct(F.lit(0).cast("long").alias("window_start_time")))
    day = FT.ms_to_wall("ts_ms").cast("date")
    return e.select(
        "event_id", FT.ms_to_datetime_str("ts_ms").alias("at"), FT.format_wall(FT.ms_to_wall("ts_ms"), "yyyy/MM/dd").alias("shown"),
        FK.md5_key("user_id").alias("user_md5"), FK.composite_key(["user_id", "event_type"], md5_whole=True).alias("row_key"),
        FK.composite_key(["user_id", "event_type"], md5_items=True).alias("parts_key"),
        FT.json_time_field(both, "block_timestamp").alias("json_time"), FT.first_present_time(first).alias("first_time"),
        FT.head_element_time(head).alias("head_time"),
        F.size(FT.day_list(day, F.date_add(day, (F.col("k") % 4).cast("int")))).cast("long").alias("n_days"))
