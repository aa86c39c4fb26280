"""Registered queries over the driver tables, each with its DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` runs the Spark implementation;
``ORACLE[name]`` is independent SQL (DuckDB dialect) over the driver views
computing the same result.  Every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.bloom import bloom_dedup
from ..operators.keyed import dealt
from ..operators.parse import split_dirty, split_log, unpack_cdc
from ..operators.segment import segment
from ..operators.ttl import daily_unique_with_ttl, monotone_with_ttl, retract_with_ttl
from ..operators.user_aggregate import QuantileSketch, aggregate
from . import adapters as AD
from . import retail as R

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- shared Spark stages

def app_log_streams(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """S1 -> P1 -> P2: the five split streams (plus ``dirty``) of the app log."""
    log = AD.topic(spark, sf_dir, "app_log",
                   lambda s, d: AD.app_log_json(AD.load(s, d, "events")))
    parts = split_dirty(log, keep=("arrival",))
    streams = split_log(parts["clean"], keep=("arrival",))
    streams["dirty"] = parts["dirty"]
    streams["clean_all"] = parts["clean"]
    return streams


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.flatten_page(app_log_streams(spark, sf_dir)["page"])


# ---------------------------------------------------------------- DuckDB shared text
_LOG = AD.SQL("app_log")
_CLEAN = f"(SELECT * FROM {_LOG} l WHERE arrival % 50 <> 7)"        # P1 drops broken payloads
_PAGES = f"(SELECT * FROM {_CLEAN} c WHERE NOT is_start)"            # P2 page stream
_TS = "make_timestamp(ts_ms * 1000)"


def _bucket(width: str, ts: str = _TS) -> str:
    return f"time_bucket(INTERVAL '{width}', {ts}, TIMESTAMP '1970-01-01 00:00:00')"


def _bounds(width: str, ts: str = _TS) -> str:
    b = _bucket(width, ts)
    return (f"strftime({b}, '%Y-%m-%d %H:%M:%S') AS stt, "
            f"strftime({b} + INTERVAL '{width}', '%Y-%m-%d %H:%M:%S') AS edt, "
            f"strftime({b}, '%Y-%m-%d') AS cur_date")


def _day(ts_ms: str = "ts_ms") -> str:
    return f"strftime(make_timestamp({ts_ms} * 1000), '%Y-%m-%d')"


# ================================================================ pipeline R
@register("page_view_window", f"""
WITH b AS (
  SELECT *, {_day()} AS d, lag({_day()}) OVER (PARTITION BY mid ORDER BY arrival) AS pd FROM {_PAGES} p)
SELECT {_bounds('10 seconds')}, vc, ch, ar, is_new,
       CAST(sum(CASE WHEN pd IS NULL OR pd <> d THEN 1 ELSE 0 END) AS BIGINT) AS uv_ct,
       CAST(sum(CASE WHEN last_page_id IS NULL OR last_page_id = '' THEN 1 ELSE 0 END) AS BIGINT) AS sv_ct,
       CAST(count(*) AS BIGINT) AS pv_ct,
       CAST(sum(coalesce(during_time, 0)) AS BIGINT) AS dur_sum
FROM b GROUP BY ALL
""")
def q_page_view_window(spark, sf_dir):
    return R.page_view_job(page_rows(spark, sf_dir))


def _bounds_key(width: str, ts: str) -> str:
    b = _bucket(width, ts)
    return (f"strftime({b}, '%Y-%m-%d %H:%M:%S') AS stt, "
            f"strftime({b} + INTERVAL '{width}', '%Y-%m-%d %H:%M:%S') AS edt, "
            f"strftime({b}, '%Y%m%d') AS cur_date")


@register("home_detail_uv", f"""
WITH b AS (
  SELECT *, {_day()} AS d, lag({_day()}) OVER (PARTITION BY mid, page_id ORDER BY arrival) AS pd
  FROM {_PAGES} p WHERE page_id IN ('home', 'good_detail')),
f AS (
  SELECT *, CASE WHEN page_id = 'home' AND (pd IS NULL OR pd <> d) THEN 1 ELSE 0 END AS h,
            CASE WHEN page_id = 'good_detail' AND (pd IS NULL OR pd <> d) THEN 1 ELSE 0 END AS g FROM b)
SELECT {_bounds('5 seconds')}, CAST(sum(h) AS BIGINT) AS home_uv_ct, CAST(sum(g) AS BIGINT) AS good_detail_uv_ct
FROM f WHERE h + g > 0 GROUP BY ALL
""")
def q_home_detail_uv(spark, sf_dir):
    return R.home_detail_job(page_rows(spark, sf_dir))


@register("login_return_users", f"""
WITH l AS (SELECT * FROM {_PAGES} p
           WHERE uid IS NOT NULL AND uid <> '' AND (last_page_id = 'login' OR last_page_id IS NULL OR last_page_id = '')),
b AS (SELECT *, {_day()} AS d, lag({_day()}) OVER (PARTITION BY uid ORDER BY arrival) AS pd FROM l),
f AS (SELECT *, CASE WHEN pd IS NULL OR pd <> d THEN 1 ELSE 0 END AS uu,
             CASE WHEN pd IS NOT NULL AND pd <> d
                   AND (ts_ms - epoch_ms(CAST(pd AS TIMESTAMP))) // 86400000 >= 8 THEN 1 ELSE 0 END AS back FROM b)
SELECT {_bounds('1 second')}, CAST(sum(back) AS BIGINT) AS back_ct, CAST(sum(uu) AS BIGINT) AS uu_ct
FROM f WHERE uu = 1 OR back = 1 GROUP BY ALL
""")
def q_login_return_users(spark, sf_dir):
    return R.login_job(page_rows(spark, sf_dir))


_CART = f"(SELECT event_id AS arrival, user_id, ts_ms FROM {AD.SQL('base')} b WHERE event_type = 'purchase')"


def cart_adds(spark, sf_dir):
    return (AD.events_base(AD.load(spark, sf_dir, "events")).where("event_type = 'purchase'")
            .selectExpr("event_id AS arrival", "user_id", "ts_ms AS ts"))


@register("cart_unique_users", f"""
WITH b AS (SELECT *, {_day()} AS d, lag({_day()}) OVER (PARTITION BY user_id ORDER BY arrival) AS pd FROM {_CART} c)
SELECT {_bounds('5 seconds')}, CAST(count(*) AS BIGINT) AS cart_add_uu_ct
FROM b WHERE pd IS NULL OR pd <> d GROUP BY ALL
""")
def q_cart_unique_users(spark, sf_dir):
    return R.cart_job(cart_adds(spark, sf_dir))


@register("new_visitor_repair", f"""
WITH p AS (SELECT arrival, mid, is_new, ts_ms FROM {_CLEAN} c),
f AS (SELECT mid, arg_min(is_new, arrival) AS fi, arg_min(ts_ms, arrival) AS ft FROM p GROUP BY mid),
s AS (SELECT mid, CASE WHEN fi = '1' THEN {_day('ft')} ELSE {_day('(ft - 86400000)')} END AS fd FROM f)
SELECT p.arrival, p.mid, p.is_new, p.ts_ms AS ts,
       CASE WHEN p.is_new = '1' AND s.fd <> {_day('p.ts_ms')} THEN '0' ELSE p.is_new END AS is_new_fixed
FROM p JOIN s USING (mid)
""")
def q_new_visitor_repair(spark, sf_dir):
    clean = app_log_streams(spark, sf_dir)["clean_all"]
    recs = clean.select("arrival", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"), "ts")
    return R.new_visitor_job(recs)


# ---------------------------------------------------------------- P1 / P2 split streams
@register("dirty_split", f"""
SELECT arrival, CASE WHEN arrival % 50 = 7 THEN 'dirty' ELSE 'clean' END AS stream,
       CASE WHEN arrival % 50 = 7 THEN NULL ELSE mid END AS mid FROM {_LOG} l
""")
def q_dirty_split(spark, sf_dir):
    s = app_log_streams(spark, sf_dir)
    dirty = s["dirty"].select("arrival", F.lit("dirty").alias("stream"), F.lit(None).cast("string").alias("mid"))
    clean = s["clean_all"].select("arrival", F.lit("clean").alias("stream"), F.col("common.mid").alias("mid"))
    return dirty.unionByName(clean)


@register("log_split_err", f"SELECT arrival, err_code AS error_code FROM {_CLEAN} c WHERE err_code IS NOT NULL")
def q_log_split_err(spark, sf_dir):
    return app_log_streams(spark, sf_dir)["err"].select("arrival", F.col("err")["error_code"].alias("error_code"))


@register("log_split_start",
          f"SELECT arrival, mid, start_entry AS entry, ts_ms AS ts FROM {_CLEAN} c WHERE is_start")
def q_log_split_start(spark, sf_dir):
    return app_log_streams(spark, sf_dir)["start"].select(
        "arrival", F.col("common.mid").alias("mid"), F.col("start")["entry"].alias("entry"), "ts")


@register("log_split_display", f"""
SELECT arrival, mid, page_id, CAST(k AS VARCHAR) AS item, '1' AS pos_id, ts_ms AS ts FROM {_PAGES} p WHERE n_displays >= 1
UNION ALL
SELECT arrival, mid, page_id, CAST(k + 1 AS VARCHAR) AS item, '2' AS pos_id, ts_ms AS ts FROM {_PAGES} p WHERE n_displays >= 2
""")
def q_log_split_display(spark, sf_dir):
    d = app_log_streams(spark, sf_dir)["display"]
    return d.select("arrival", F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"),
                    F.col("display")["item"].alias("item"), F.col("display")["pos_id"].alias("pos_id"), "ts")


@register("log_split_action", f"""
SELECT arrival, mid, page_id, 'cart_add' AS action_id, CAST(k AS VARCHAR) AS item FROM {_PAGES} p WHERE n_actions >= 1
UNION ALL
SELECT arrival, mid, page_id, 'cart_add' AS action_id, CAST(k + 1 AS VARCHAR) AS item FROM {_PAGES} p WHERE n_actions >= 2
""")
def q_log_split_action(spark, sf_dir):
    a = app_log_streams(spark, sf_dir)["action"]
    return a.select("arrival", F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"),
                    F.col("action")["action_id"].alias("action_id"), F.col("action")["item"].alias("item"))


@register("log_split_page", f"""
SELECT arrival, mid, page_id, last_page_id, during_time, ts_ms AS ts,
       n_displays = 0 AS has_displays, n_actions = 0 AS has_actions FROM {_PAGES} p
""")
def q_log_split_page(spark, sf_dir):
    p = app_log_streams(spark, sf_dir)["page"]
    return p.select("arrival", F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"),
                    F.col("page.last_page_id").alias("last_page_id"),
                    F.col("page.during_time").alias("during_time"), "ts",
                    F.col("displays").isNotNull().alias("has_displays"),
                    F.col("actions").isNotNull().alias("has_actions"))


# ---------------------------------------------------------------- keyword search
_SPLIT = r"[^\p{L}\p{N}]+"


@register("keyword_count_3d", f"""
WITH s AS (SELECT d.text, e.ts FROM documents d JOIN events e ON d.doc_id = e.event_id WHERE d.text IS NOT NULL),
w AS (SELECT unnest(string_split_regex(lower(text), '{_SPLIT}')) AS keyword, ts FROM s)
SELECT {_bounds_key('3 days', 'ts')}, keyword, CAST(count(*) AS BIGINT) AS keyword_count
FROM w WHERE keyword <> '' GROUP BY ALL
""")
def q_keyword_count_3d(spark, sf_dir):
    docs = AD.load(spark, sf_dir, "documents")
    ev = AD.load(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), F.col("ts").alias("et"))
    page = F.create_map(F.lit("last_page_id"), F.lit("search"), F.lit("item_type"), F.lit("keyword"),
                        F.lit("item"), F.col("text"))
    searches = docs.join(ev, "doc_id").select(page.alias("page"), "et")
    return R.keyword_job(searches)


# ---------------------------------------------------------------- trade jobs
_ARR = ", ".join(AD.LINEITEM_ARRIVAL)
_DETAILS = f"(SELECT {_ARR}, " + ", ".join(f"{e} AS {n}" for n, e in AD.ORDER_DETAIL.items()) + " FROM lineitem)"
_AMTS = ["split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]


def details(spark, sf_dir):
    return AD.order_details(AD.load(spark, sf_dir, "lineitem"))


@register("retract_stream", f"""
WITH d AS (SELECT *, row_number() OVER (PARTITION BY detail_id ORDER BY {', '.join(c + ' DESC' for c in AD.LINEITEM_ARRIVAL)}) AS rd
           FROM {_DETAILS} x)
SELECT detail_id, order_id, sku_id, strftime(et, '%Y-%m-%d') AS et,
       {', '.join(f'CAST({a} AS DOUBLE) AS {a}' for a in _AMTS)}, 0 AS is_retract FROM d
UNION ALL
SELECT detail_id, order_id, sku_id, strftime(et, '%Y-%m-%d') AS et,
       {', '.join(f'CAST(-{a} AS DOUBLE) AS {a}' for a in _AMTS)}, 1 AS is_retract FROM d WHERE rd > 1
""")
def q_retract_stream(spark, sf_dir):
    r = R.retractions(details(spark, sf_dir), AD.LINEITEM_ARRIVAL)
    return r.select("detail_id", "order_id", "sku_id", F.date_format("et", "yyyy-MM-dd").alias("et"),
                    *[F.col(a).cast("double").alias(a) for a in _AMTS], "is_retract")


def sku_dims(spark, sf_dir):
    """The six dimensions of the sku chain, derived from ``part``."""
    part = AD.load(spark, sf_dir, "part")
    sku = part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
                      F.col("p_brand").alias("spu_id"), F.col("p_size").cast("string").alias("tm_id"),
                      F.col("p_type").alias("category3_id"))
    spu = part.select(F.col("p_brand").alias("id")).distinct().withColumn("spu_name", F.lower("id"))
    tm = sku.select(F.col("tm_id").alias("id")).distinct().withColumn("tm_name", F.concat(F.lit("tm-"), "id"))
    c3 = (part.select(F.col("p_type").alias("id")).distinct()
          .withColumn("name", F.lower("id"))
          .withColumn("category2_id", F.when(F.col("id").isin("SMALL", "MEDIUM", "LARGE"), "SIZE").otherwise("GRADE")))
    c2 = (c3.select(F.col("category2_id").alias("id")).distinct()
          .withColumn("name", F.lower("id"))
          .withColumn("category1_id", F.concat(F.lit("C1-"), F.substring("id", 1, 1))))
    c1 = c2.select(F.col("category1_id").alias("id")).distinct().withColumn("name", F.lower("id"))
    return [
        ("sku_id", sku, "id", {"sku_name": "sku_name", "spu_id": "spu_id", "tm_id": "tm_id",
                               "category3_id": "category3_id"}),
        ("spu_id", spu, "id", {"spu_name": "spu_name"}),
        ("tm_id", tm, "id", {"tm_name": "tm_name"}),
        ("category3_id", c3, "id", {"name": "category3_name", "category2_id": "category2_id"}),
        ("category2_id", c2, "id", {"name": "category2_name", "category1_id": "category1_id"}),
        ("category1_id", c1, "id", {"name": "category1_name"}),
    ]


_SKU_DIMS = """
sku AS (SELECT p_partkey AS id, p_name AS sku_name, p_brand AS spu_id, CAST(p_size AS VARCHAR) AS tm_id,
               p_type AS category3_id FROM part),
spu AS (SELECT DISTINCT p_brand AS id, lower(p_brand) AS spu_name FROM part),
tm AS (SELECT DISTINCT CAST(p_size AS VARCHAR) AS id, 'tm-' || CAST(p_size AS VARCHAR) AS tm_name FROM part),
c3 AS (SELECT DISTINCT p_type AS id, lower(p_type) AS name,
              CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'SIZE' ELSE 'GRADE' END AS category2_id FROM part),
c2 AS (SELECT DISTINCT category2_id AS id, lower(category2_id) AS name, 'C1-' || substr(category2_id, 1, 1) AS category1_id FROM c3),
c1 AS (SELECT DISTINCT category1_id AS id, lower(category1_id) AS name FROM c2)
"""


def _money(expr: str, name: str) -> str:
    return f"CAST(CAST(sum({expr}) AS DECIMAL(18,2)) AS DOUBLE) AS {name}"


@register("sku_order_window", f"""
WITH d AS (SELECT *, row_number() OVER (PARTITION BY detail_id ORDER BY {', '.join(c + ' DESC' for c in AD.LINEITEM_ARRIVAL)}) AS rd
           FROM {_DETAILS} x),
r AS (SELECT sku_id, et, {', '.join(_AMTS)} FROM d
      UNION ALL SELECT sku_id, et, {', '.join('-' + a for a in _AMTS)} FROM d WHERE rd > 1),
a AS (SELECT {_bounds('5 seconds', 'et')}, sku_id,
             {_money('split_original_amount', 'original_amount')}, {_money('split_activity_amount', 'activity_reduce_amount')},
             {_money('split_coupon_amount', 'coupon_reduce_amount')}, {_money('split_total_amount', 'order_amount')}
      FROM r GROUP BY ALL),
{_SKU_DIMS}
SELECT a.*, sku.sku_name, sku.spu_id, sku.tm_id, sku.category3_id, spu.spu_name, tm.tm_name,
       c3.name AS category3_name, c3.category2_id, c2.name AS category2_name, c2.category1_id, c1.name AS category1_name
FROM a LEFT JOIN sku ON a.sku_id = sku.id LEFT JOIN spu ON sku.spu_id = spu.id LEFT JOIN tm ON sku.tm_id = tm.id
LEFT JOIN c3 ON sku.category3_id = c3.id LEFT JOIN c2 ON c3.category2_id = c2.id LEFT JOIN c1 ON c2.category1_id = c1.id
""")
def q_sku_order_window(spark, sf_dir):
    return R.sku_order_job(details(spark, sf_dir), AD.LINEITEM_ARRIVAL, sku_dims(spark, sf_dir))


def with_province(spark, sf_dir, d):
    """Order details carrying the buyer's province (customer nation)."""
    o = AD.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = AD.load(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("province_id"))
    buyers = o.join(c, o["o_custkey"] == c["c_custkey"], "left").select("o_orderkey", "province_id")
    d = dealt(d, AD.load(spark, sf_dir, "lineitem").count(), ["order_id"])
    return d.join(buyers, d["order_id"] == buyers["o_orderkey"], "left").drop("o_orderkey")


@register("province_order_window", f"""
WITH x AS (SELECT x.*, c.c_nationkey AS province_id FROM {_DETAILS} x
           LEFT JOIN orders o ON x.order_id = o.o_orderkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
d AS (SELECT *, row_number() OVER (PARTITION BY detail_id ORDER BY {', '.join(c + ' DESC' for c in AD.LINEITEM_ARRIVAL)}) AS rd FROM x),
r AS (SELECT province_id, order_id, et, split_total_amount FROM d
      UNION ALL SELECT province_id, order_id, et, -split_total_amount FROM d WHERE rd > 1),
a AS (SELECT {_bounds('10 seconds', 'et')}, province_id, CAST(count(DISTINCT order_id) AS BIGINT) AS order_count,
             {_money('split_total_amount', 'order_amount')} FROM r GROUP BY ALL)
SELECT a.*, n.n_name AS province_name FROM a LEFT JOIN nation n ON a.province_id = n.n_nationkey
""")
def q_province_order_window(spark, sf_dir):
    nation = AD.load(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return R.province_order_job(details(spark, sf_dir), AD.LINEITEM_ARRIVAL, nation, province_of=lambda d: with_province(spark, sf_dir, d))


# ================================================================ pipeline G
from . import traffic as G  # noqa: E402


def envelopes(spark, sf_dir):
    return AD.topic(spark, sf_dir, "cdc", lambda s, d: AD.cdc_envelopes(AD.load(s, d, "events")))


def ods(spark, sf_dir, flag: bool = True):
    """Change-envelope topic at rest -> U1 + U2 (where the flag is read) + P18."""
    return G.ods_records(envelopes(spark, sf_dir), flag=flag)


def _dwd(spark, sf_dir):
    o = ods(spark, sf_dir, flag=False)
    return {"uv": G.dwd_user_visit(ods(spark, sf_dir)), "uv_plain": G.dwd_user_visit(o), "pi": G.dwd_product_interaction(o), "pay": G.dwd_order_pay(o),
            "se": G.dwd_search(o), "pc": G.dwd_page_click(o), "cr": G.dwd_crowd_attribute(o)}


_ODS = AD.SQL("ods")
_HOUR = "(CAST(evt_time AS BIGINT) // 3600000) * 3600000"
_DAYMS = "(CAST(evt_time AS BIGINT) // 86400000) * 86400000"
_G = f"""
o AS (SELECT * FROM {_ODS} x WHERE op IN ('r', 'c', 'u', 'd')),
v AS (SELECT *, CASE WHEN tbl <> 'ods_order_pay_log' THEN visitor_id END AS vid FROM o),
f AS (SELECT *, CASE WHEN vid IS NULL THEN NULL
                     WHEN row_number() OVER (PARTITION BY vid ORDER BY event_id) = 1 THEN '1' ELSE '0' END AS first_flag
      FROM v),
uv AS (SELECT event_id AS arrival, CAST(log_id AS BIGINT) AS log_id, CAST(evt_time AS BIGINT) AS visit_time, visitor_id,
              terminal_type, visit_object_type, CAST(visit_object_id AS BIGINT) AS visit_object_id,
              traffic_source_first, traffic_source_second, CAST(first_flag AS INTEGER) AS is_new_visitor,
              CAST(page_view AS INTEGER) AS page_view, CAST(stay_time AS INTEGER) AS stay_time,
              {_HOUR} AS stat_time, CAST(10001 AS BIGINT) AS shop_id
       FROM f WHERE tbl = 'ods_user_visit_log' AND NOT regexp_full_match(visitor_id, '[\\x00-\\x20]*') AND evt_time IS NOT NULL),
pi AS (SELECT event_id AS arrival, CAST(log_id AS BIGINT) AS log_id, CAST(evt_time AS BIGINT) AS interact_time,
              visitor_id, terminal_type, CAST(product_id AS BIGINT) AS product_id, interact_type,
              CAST(is_cancel AS INTEGER) AS is_cancel, {_HOUR} AS stat_time, CAST(10001 AS BIGINT) AS shop_id
       FROM f WHERE tbl = 'ods_product_interaction_log' AND evt_time IS NOT NULL AND coalesce(CAST(is_cancel AS INTEGER), 0) <> 1),
pay AS (SELECT event_id AS arrival, CAST(log_id AS BIGINT) AS log_id, CAST(order_id AS BIGINT) AS order_id,
               CAST(evt_time AS BIGINT) AS pay_time, buyer_id, terminal_type, CAST(product_id AS BIGINT) AS product_id,
               pay_amount, CAST(is_paid AS INTEGER) AS is_paid, 1 AS pay_quantity, {_HOUR} AS stat_time,
               CAST(10001 AS BIGINT) AS shop_id
        FROM f WHERE tbl = 'ods_order_pay_log' AND evt_time IS NOT NULL AND CAST(is_paid AS INTEGER) = 1),
se AS (SELECT event_id AS arrival, CAST(log_id AS BIGINT) AS log_id, CAST(evt_time AS BIGINT) AS search_time, visitor_id,
              terminal_type, keyword, CAST(is_click_result AS INTEGER) AS is_click_result,
              CAST(click_product_id AS BIGINT) AS click_product_id, {_DAYMS} AS stat_time, 'day' AS stat_dimension,
              CAST(10001 AS BIGINT) AS shop_id
       FROM f WHERE tbl = 'ods_search_log' AND evt_time IS NOT NULL),
pc AS (SELECT event_id AS arrival, CAST(log_id AS BIGINT) AS log_id, CAST(evt_time AS BIGINT) AS click_time, visitor_id,
              terminal_type, CAST(page_id AS BIGINT) AS page_id, module_name, module_position,
              CAST(guide_product_id AS BIGINT) AS guide_product_id, {_HOUR} AS stat_time, CAST(10001 AS BIGINT) AS shop_id
       FROM f WHERE tbl = 'ods_page_click_log' AND evt_time IS NOT NULL),
cr AS (SELECT event_id AS arrival, CAST(log_id AS BIGINT) AS log_id, visitor_id, gender, age_range, city,
              CAST(taoqi_value AS INTEGER) AS taoqi_value, CAST(evt_time AS BIGINT) AS update_time,
              {_DAYMS} AS stat_time, CAST(10001 AS BIGINT) AS shop_id
       FROM f WHERE tbl = 'ods_crowd_attribute_log' AND evt_time IS NOT NULL),
ov AS (SELECT arrival, stat_time, terminal_type, shop_id, visit_time,
              CASE WHEN visit_object_type = 'shop' THEN 1 ELSE 0 END AS shop_visitor_count,
              CASE WHEN visit_object_type = 'shop' THEN page_view ELSE 0 END AS shop_page_view,
              CASE WHEN visit_object_type = 'shop' AND is_new_visitor = 1 THEN 1 ELSE 0 END AS new_visitor_count,
              CASE WHEN visit_object_type = 'shop' AND NOT coalesce(is_new_visitor = 1, false) THEN 1 ELSE 0 END AS old_visitor_count,
              CASE WHEN visit_object_type = 'product' THEN 1 ELSE 0 END AS product_visitor_count,
              CASE WHEN visit_object_type = 'product' THEN page_view ELSE 0 END AS product_page_view,
              0 AS add_collection_count, 0 AS pay_buyer_count, CAST(0 AS DECIMAL(18,2)) AS pay_amount FROM uv),
src AS (SELECT arrival, stat_time, terminal_type, shop_id, visit_time, traffic_source_first, traffic_source_second,
               1 AS visitor_count, visit_object_id AS related_product_id,
               CASE WHEN visit_object_type = 'product' THEN 1 ELSE 0 END AS product_visitor_count,
               CAST(0 AS DECIMAL(18,2)) AS product_pay_amount FROM uv),
kw AS (SELECT arrival, strftime(make_timestamp(stat_time * 1000), '%Y-%m-%d') AS stat_time, stat_dimension,
              terminal_type, shop_id, search_time, keyword, 1 AS search_visitor_count,
              is_click_result AS click_visitor_count FROM se),
pt AS (SELECT arrival, stat_time, terminal_type, shop_id, visit_time, visit_object_id AS product_id, 1 AS visitor_count,
              page_view, stay_time AS avg_stay_time, 0 AS add_cart_count, 0 AS collection_count, 0 AS pay_buyer_count,
              CAST(0 AS DECIMAL(18,2)) AS pay_amount FROM uv WHERE visit_object_type = 'product'),
pg AS (SELECT arrival, stat_time, terminal_type, shop_id, visit_time, visit_object_id AS page_id, 1 AS visitor_count,
              page_view, 0 AS click_count, stay_time AS avg_stay_time FROM uv WHERE visit_object_type = 'page'),
cf AS (SELECT arrival, stat_time, 'overall' AS terminal_type, shop_id, update_time, t.crowd_type, gender, age_range,
              city, taoqi_value, 1 AS crowd_count, 1 AS total_crowd_count, CAST(1.0000 AS DECIMAL(5,4)) AS crowd_ratio
       FROM cr CROSS JOIN (VALUES ('shop_entry'), ('product_visit'), ('conversion')) t(crowd_type))
"""


@register("cdc_unpack_route", f"""
WITH {_G}
SELECT event_id AS arrival, tbl AS topic, op, vid AS visitor_id,
       CASE WHEN tbl = 'ods_crowd_attribute_log' THEN NULL ELSE terminal_type END AS terminal_type,
       CASE WHEN tbl = 'ods_user_visit_log' THEN first_flag END AS is_new_visitor
FROM f
""")
def q_cdc_unpack_route(spark, sf_dir):
    o = ods(spark, sf_dir)
    d = F.col("data")
    return o.select("arrival", "topic", "op", d["visitor_id"].alias("visitor_id"),
                    d["terminal_type"].alias("terminal_type"), d["is_new_visitor"].alias("is_new_visitor"))


@register("first_seen_flag", f"""
WITH {_G}
SELECT event_id AS arrival, vid AS visitor_id, first_flag AS is_new_visitor FROM f
""")
def q_first_seen_flag(spark, sf_dir):
    from ..operators.parse import unpack_cdc
    env = AD.topic(spark, sf_dir, "cdc", lambda s, d: AD.cdc_envelopes(AD.load(s, d, "events")))
    u = G.flag_new_visitors(unpack_cdc(env, keep=("arrival",)), only_if_present=False)
    d = F.col("data")
    return u.select("arrival", d["visitor_id"].alias("visitor_id"), d["is_new_visitor"].alias("is_new_visitor"))


@register("visitor_split", f"""
WITH {_G}
SELECT event_id AS arrival, tbl, vid AS visitor_id, CASE WHEN first_flag = '1' THEN 'new' ELSE 'old' END AS stream
FROM f WHERE vid IS NOT NULL
""")
def q_visitor_split(spark, sf_dir):
    from ..operators.parse import unpack_cdc
    split = G.visitor_split(unpack_cdc(envelopes(spark, sf_dir), keep=("arrival",)))
    return split.select("arrival", F.col("_table").alias("tbl"), F.col("data")["visitor_id"].alias("visitor_id"), "stream")


for _name, _key, _cte in [("dwd_user_visit", "uv", "uv"), ("dwd_product_interaction", "pi", "pi"),
                          ("dwd_order_pay", "pay", "pay"), ("dwd_search", "se", "se"),
                          ("dwd_page_click", "pc", "pc"), ("dwd_crowd_attribute", "cr", "cr")]:
    register(_name, f"WITH {_G} SELECT * FROM {_cte}")(
        (lambda key: lambda spark, sf_dir: _dwd(spark, sf_dir)[key])(_key))


_ARRAYS = ["sub_source_list", "traffic_source_json", "module_click_json", "guide_product_json"]


def _dws(spark, sf_dir):
    w = _dwd(spark, sf_dir)
    return {"ov": G.dws_traffic_overview(w["uv"]), "src": G.dws_traffic_source(w["uv_plain"]),
            "kw": G.dws_keyword(w["se"]), "pt": G.dws_product_traffic(w["uv_plain"]),
            "pg": G.dws_page_traffic(w["uv_plain"]), "cf": G.dws_crowd_feature(w["cr"])}


for _name, _key in [("dws_traffic_overview", "ov"), ("dws_traffic_source", "src"), ("dws_keyword", "kw"),
                    ("dws_product_traffic", "pt"), ("dws_page_traffic", "pg"), ("dws_crowd_feature", "cf")]:
    register(_name, f"WITH {_G} SELECT * FROM {_key}")(
        (lambda key: lambda spark, sf_dir: _dws(spark, sf_dir)[key].drop(*_ARRAYS))(_key))


def _win(width: str, ms: str) -> str:
    b = _bucket(width, f"make_timestamp({ms} * 1000)")
    return (f"strftime({b}, '%Y-%m-%d %H:%M:%S') AS window_start, "
            f"strftime({b} + INTERVAL '{width}', '%Y-%m-%d %H:%M:%S') AS window_end")


def _sl(c: str, name: str | None = None) -> str:
    return f"CAST(sum(coalesce({c}, 0)) AS BIGINT) AS {name or c}"


@register("ads_traffic_summary", f"""
WITH {_G}
SELECT stat_time, terminal_type, shop_id, {_win('1 hour', 'visit_time')},
       {_sl('shop_visitor_count', 'total_shop_visitor')}, {_sl('shop_page_view', 'total_shop_pv')},
       {_sl('new_visitor_count', 'total_new_visitor')}, {_sl('old_visitor_count', 'total_old_visitor')},
       {_sl('product_visitor_count', 'total_product_visitor')}, {_sl('product_page_view', 'total_product_pv')},
       {_sl('add_collection_count', 'total_add_collection')}, {_sl('pay_buyer_count', 'total_pay_buyer')},
       {_money('pay_amount', 'total_pay_amount')}
FROM ov GROUP BY ALL
""")
def q_ads_traffic_summary(spark, sf_dir):
    return G.ads_traffic_summary(_dws(spark, sf_dir)["ov"])


@register("ads_traffic_source_topn", f"""
WITH {_G},
a AS (SELECT stat_time, terminal_type, shop_id, traffic_source_first AS traffic_source, {_win('1 hour', 'visit_time')},
             {_sl('visitor_count', 'total_visitor')}, {_sl('product_visitor_count', 'total_product_visitor')},
             {_money('product_pay_amount', 'total_product_pay')},
             arg_max_null(traffic_source_second, arrival) AS traffic_source_second
      FROM src GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY stat_time, terminal_type, shop_id, window_start
                                   ORDER BY total_visitor DESC, traffic_source ASC NULLS FIRST) AS ranking FROM a)
SELECT * FROM r WHERE ranking <= 10
""")
def q_ads_traffic_source_topn(spark, sf_dir):
    return G.ads_traffic_source_topn(_dws(spark, sf_dir)["src"])


@register("ads_keyword_topn", f"""
WITH {_G},
a AS (SELECT stat_time, stat_dimension, terminal_type, shop_id, keyword, {_win('1 day', 'search_time')},
             {_sl('search_visitor_count', 'total_search_visitor')}, {_sl('click_visitor_count', 'total_click_visitor')}
      FROM kw GROUP BY ALL),
r AS (SELECT *, CASE WHEN total_search_visitor > 0 THEN CAST(total_click_visitor AS DOUBLE) / total_search_visitor
                     ELSE 0.0 END AS click_rate,
             row_number() OVER (PARTITION BY stat_time, stat_dimension, terminal_type, shop_id, window_start
                                ORDER BY total_search_visitor DESC, keyword ASC NULLS FIRST) AS ranking FROM a)
SELECT * FROM r WHERE ranking <= 20
""")
def q_ads_keyword_topn(spark, sf_dir):
    return G.ads_keyword_topn(_dws(spark, sf_dir)["kw"])


@register("ads_product_topn", f"""
WITH {_G},
a AS (SELECT stat_time, terminal_type, shop_id, product_id, {_win('2 hours', 'visit_time')},
             {_sl('visitor_count', 'total_visitor')}, {_sl('page_view', 'total_pv')},
             {_sl('add_cart_count', 'total_add_cart')}, {_sl('collection_count', 'total_collection')},
             {_sl('pay_buyer_count', 'total_pay_buyer')}, {_money('pay_amount', 'total_pay_amount')}
      FROM pt GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY stat_time, terminal_type, shop_id, window_start
                                   ORDER BY total_visitor DESC, product_id ASC NULLS FIRST) AS ranking FROM a)
SELECT * FROM r WHERE ranking <= 15
""")
def q_ads_product_topn(spark, sf_dir):
    return G.ads_product_topn(_dws(spark, sf_dir)["pt"])


@register("ads_page_performance", f"""
WITH {_G},
a AS (SELECT stat_time, terminal_type, shop_id, page_id, {_win('1 hour', 'visit_time')},
             {_sl('visitor_count', 'total_visitor')}, {_sl('page_view', 'total_pv')},
             {_sl('click_count', 'total_click')}, {_sl('avg_stay_time', 'sum_stay_time')}
      FROM pg GROUP BY ALL)
SELECT *, CAST(CASE WHEN total_pv > 0 THEN sum_stay_time // total_pv ELSE 0 END AS BIGINT) AS avg_stay_time FROM a
""")
def q_ads_page_performance(spark, sf_dir):
    return G.ads_page_performance(_dws(spark, sf_dir)["pg"])


def _legacy(cte: str, keys: str, entity: str, win: str, sums: str, n: int | None, by: str | None) -> str:
    ranked = (f"SELECT *, row_number() OVER (PARTITION BY {keys}, window_start ORDER BY {by} DESC, {entity} ASC NULLS FIRST) AS ranking FROM a"
              if n else "SELECT * FROM a")
    return f"WITH {_G}, a AS (SELECT {keys}, arg_max_null({entity}, arrival) AS {entity}, {win}, {sums} FROM {cte} GROUP BY ALL) {ranked}"


@register("ads_keyword_legacy", "SELECT *, CASE WHEN total_search_visitor > 0 THEN CAST(total_click_visitor AS DOUBLE) / total_search_visitor "
          "ELSE 0.0 END AS click_rate FROM (" + _legacy(
              "kw", "stat_time, stat_dimension, terminal_type, shop_id", "keyword", _win("1 day", "search_time"),
              f"{_sl('search_visitor_count', 'total_search_visitor')}, {_sl('click_visitor_count', 'total_click_visitor')}",
              20, "total_search_visitor") + ") x")
def q_ads_keyword_legacy(spark, sf_dir):
    return G.ads_keyword_topn(_dws(spark, sf_dir)["kw"], legacy_key=True)


@register("ads_product_legacy", _legacy(
    "pt", "stat_time, terminal_type, shop_id", "product_id", _win("2 hours", "visit_time"),
    f"{_sl('visitor_count', 'total_visitor')}, {_sl('page_view', 'total_pv')}, {_sl('add_cart_count', 'total_add_cart')}, "
    f"{_sl('collection_count', 'total_collection')}, {_sl('pay_buyer_count', 'total_pay_buyer')}, {_money('pay_amount', 'total_pay_amount')}",
    15, "total_visitor"))
def q_ads_product_legacy(spark, sf_dir):
    return G.ads_product_topn(_dws(spark, sf_dir)["pt"], legacy_key=True)


@register("ads_page_legacy", "SELECT *, CAST(CASE WHEN total_pv > 0 THEN sum_stay_time // total_pv ELSE 0 END AS BIGINT) AS avg_stay_time FROM ("
          + _legacy("pg", "stat_time, terminal_type, shop_id", "page_id", _win("1 hour", "visit_time"),
                    f"{_sl('visitor_count', 'total_visitor')}, {_sl('page_view', 'total_pv')}, {_sl('click_count', 'total_click')}, "
                    f"{_sl('avg_stay_time', 'sum_stay_time')}", None, None) + ") x")
def q_ads_page_legacy(spark, sf_dir):
    return G.ads_page_performance(_dws(spark, sf_dir)["pg"], legacy_key=True)


@register("ads_crowd_analysis", f"""
WITH {_G}
SELECT stat_time, terminal_type, shop_id, crowd_type, {_win('1 day', 'update_time')},
       {_sl('crowd_count', 'total_crowd')}, arg_max_null(gender, arrival) AS gender, arg_max_null(age_range, arrival) AS age_range,
       arg_max_null(city, arrival) AS city, arg_max_null(taoqi_value, arrival) AS taoqi_value
FROM cf GROUP BY ALL
""")
def q_ads_crowd_analysis(spark, sf_dir):
    return G.ads_crowd_analysis(_dws(spark, sf_dir)["cf"])


# ================================================================ lookups, dedup, maintenance
from ..functions.keys import hash_bucket  # noqa: E402
from ..functions.text import is_blank, matches_allowed, word_tokens  # noqa: E402
from ..operators import dedup as D  # noqa: E402
from ..operators import enrich as J  # noqa: E402
from ..operators.topn import newest_n  # noqa: E402
from .. import sinks as K  # noqa: E402

_BASE = AD.SQL("base")


def _events(spark, sf_dir):
    return AD.events_base(AD.load(spark, sf_dir, "events"))


# Latest non-null value per column per key; delete changes ignored.
_DIM_CHANGES = ("(SELECT event_id, user_id, CASE event_id % 4 WHEN 0 THEN 'r' WHEN 1 THEN 'c' WHEN 2 THEN 'u' ELSE 'd' END AS op, "
                "event_type AS c_type, CASE WHEN k % 3 = 0 THEN NULL ELSE value END AS c_value, "
                "CASE WHEN k % 5 = 0 THEN NULL ELSE k END AS c_k FROM {base} b)")


@register("dim_latest_merge", f"""
SELECT user_id, arg_max(c_type, event_id) FILTER (WHERE c_type IS NOT NULL) AS c_type,
       arg_max(c_value, event_id) FILTER (WHERE c_value IS NOT NULL) AS c_value,
       arg_max(c_k, event_id) FILTER (WHERE c_k IS NOT NULL) AS c_k
FROM {_DIM_CHANGES.format(base=_BASE)} x WHERE op <> 'd' GROUP BY user_id
""")
def q_dim_latest_merge(spark, sf_dir):
    ch = _events(spark, sf_dir).selectExpr(
        "event_id", "user_id", "CASE event_id % 4 WHEN 0 THEN 'r' WHEN 1 THEN 'c' WHEN 2 THEN 'u' ELSE 'd' END AS op",
        "event_type AS c_type", "CASE WHEN k % 3 = 0 THEN NULL ELSE value END AS c_value",
        "CASE WHEN k % 5 = 0 THEN NULL ELSE k END AS c_k")
    return K.dim_upsert(None, ch, "user_id", ["c_type", "c_value", "c_k"], "event_id", op_col="op")


# Dictionary of event codes derived from the data; the 'error' code has no entry -> N/A.
@register("dict_lookup_na", """
WITH dic AS (SELECT DISTINCT event_type AS code, upper(event_type) AS dic_name FROM events WHERE event_type <> 'error')
SELECT e.event_id, e.event_type, coalesce(d.dic_name, 'N/A') AS dic_name
FROM events e LEFT JOIN dic d ON e.event_type = d.code
""")
def q_dict_lookup_na(spark, sf_dir):
    ev = AD.load(spark, sf_dir, "events").select("event_id", "event_type")
    dic = (ev.where("event_type <> 'error'").select(F.col("event_type").alias("code")).distinct()
           .withColumn("dic_name", F.upper("code")))
    return J.dict_lookup(ev, dic, "event_type", "code", "dic_name", "dic_name")


# J5 + F23: clicks joined with the same user's purchases within one hour either side.
@register("interval_join_prefix", f"""
WITH c AS (SELECT event_id, user_id, ts_ms FROM {_BASE} b WHERE event_type = 'click'),
p AS (SELECT event_id, user_id, ts_ms, value FROM {_BASE} b WHERE event_type = 'purchase')
SELECT c.event_id, c.user_id, c.ts_ms, p.event_id AS info_event_id, p.user_id AS info_user_id,
       p.ts_ms AS info_ts_ms, p.value AS info_value
FROM c JOIN p ON c.user_id = p.user_id AND p.ts_ms BETWEEN c.ts_ms - 3600000 AND c.ts_ms + 3600000
""")
def q_interval_join_prefix(spark, sf_dir):
    e = _events(spark, sf_dir)
    clicks = e.where("event_type = 'click'").select("event_id", "user_id", "ts_ms")
    buys = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts_ms", "value")
    return J.interval_join(clicks, buys, "user_id", "ts_ms", "ts_ms", 3_600_000, 3_600_000, prefix="info_")


# Word list = distinct word tokens of the benchmark passages.
_WORDS = f"(SELECT DISTINCT w AS word FROM (SELECT unnest(string_split_regex(lower(text), '{_SPLIT}')) AS w FROM benchmark) t WHERE w <> '')"


def _word_list(spark, sf_dir):
    b = AD.load(spark, sf_dir, "benchmark")
    return b.select(F.explode(word_tokens("text")).alias("word")).distinct()


@register("word_check", f"""
WITH c AS (SELECT conv_id, turn, role, list_filter(string_split_regex(lower(text), '{_SPLIT}'), lambda x: x <> '') AS toks
           FROM conversations),
l AS (SELECT conv_id, turn, role, CASE WHEN len(toks) > 0 THEN toks[len(toks)] END AS last_tok FROM c),
w AS {_WORDS}
SELECT l.conv_id, l.turn, l.role, CASE WHEN w.word IS NOT NULL THEN 1 ELSE 0 END AS is_violation,
       CASE WHEN w.word IS NOT NULL THEN 'P0' END AS violation_grade, w.word AS violation_msg
FROM l LEFT JOIN w ON l.last_tok = w.word
""")
def q_word_check(spark, sf_dir):
    conv = AD.load(spark, sf_dir, "conversations")
    comments = conv.select("conv_id", "turn", "role", F.concat_ws(",", word_tokens("text")).alias("msg"))
    return J.word_check(comments, _word_list(spark, sf_dir), "msg").drop("msg")


@register("word_batch_check", f"""
WITH c AS (SELECT conv_id, turn, list_filter(string_split_regex(lower(text), '{_SPLIT}'), lambda x: x <> '') AS toks
           FROM conversations),
e AS (SELECT conv_id, turn, unnest(range(len(toks))) AS pos, unnest(toks) AS word FROM c),
w AS {_WORDS}
SELECT e.conv_id, e.turn, CAST(e.pos AS INTEGER) AS pos, e.word, w.word IS NOT NULL AS "exists"
FROM e LEFT JOIN w ON e.word = w.word
""")
def q_word_batch_check(spark, sf_dir):
    conv = AD.load(spark, sf_dir, "conversations").select("conv_id", "turn", word_tokens("text").alias("words"))
    return J.batch_membership(conv, _word_list(spark, sf_dir), "words", ["conv_id", "turn"])


# W10 in batch: states that expire along the records' own clock.
_TTL_GATE, _TTL_LATEST, _TTL_RETRACT = 6 * 3_600_000, 3_600_000, 30 * 86_400_000


@register("daily_unique_ttl", f"""
WITH x AS (SELECT arrival, mid, ts_ms AS ts, {_day()} AS d, lag({_day()}) OVER w AS pd, ts_ms - lag(ts_ms) OVER w AS gap
           FROM {_PAGES} p WINDOW w AS (PARTITION BY mid ORDER BY arrival))
SELECT arrival, mid, ts, CAST(CASE WHEN pd IS NULL OR gap >= {_TTL_GATE} OR pd <> d THEN 1 ELSE 0 END AS BIGINT) AS uv_ct FROM x
""")
def q_daily_unique_ttl(spark, sf_dir):
    pages = page_rows(spark, sf_dir).select("arrival", "mid", "ts")
    return daily_unique_with_ttl(pages, ["mid"], "arrival", "ts", "ts", _TTL_GATE)


@register("monotone_latest_ttl", f"""
WITH x AS (SELECT event_id AS arrival, user_id, ts_ms % 86400000 AS ts_ms, ts_ms AS at_ms,
                  CASE WHEN ts_ms - lag(ts_ms) OVER (PARTITION BY user_id ORDER BY event_id) >= {_TTL_LATEST} THEN 1 ELSE 0 END AS begun
           FROM {AD.SQL('base')} b),
l AS (SELECT *, sum(begun) OVER (PARTITION BY user_id ORDER BY arrival) AS life FROM x),
m AS (SELECT *, max(ts_ms) OVER (PARTITION BY user_id, life ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM l)
SELECT arrival, user_id, ts_ms FROM m WHERE before IS NULL OR ts_ms > before
""")
def q_monotone_latest_ttl(spark, sf_dir):
    rows = AD.events_base(AD.load(spark, sf_dir, "events")).selectExpr("event_id AS arrival", "user_id", "ts_ms % 86400000 AS ts_ms", "ts_ms AS at_ms")
    return monotone_with_ttl(rows, ["user_id"], "arrival", "ts_ms", "at_ms", _TTL_LATEST).select("arrival", "user_id", "ts_ms")


@register("retract_stream_ttl", f"""
WITH d AS (SELECT *, row_number() OVER w AS arrival, epoch_ms(et) AS at_ms, lead(epoch_ms(et)) OVER w AS next_ms
           FROM {_DETAILS} x WINDOW w AS (PARTITION BY detail_id ORDER BY {_ARR}))
SELECT detail_id, arrival, {', '.join(f'CAST({a} AS DOUBLE) AS {a}' for a in _AMTS)}, 0 AS is_retract FROM d
UNION ALL
SELECT detail_id, arrival, {', '.join(f'CAST(-{a} AS DOUBLE) AS {a}' for a in _AMTS)}, 1 AS is_retract FROM d WHERE next_ms - at_ms < {_TTL_RETRACT}
""")
def q_retract_stream_ttl(spark, sf_dir):
    place = F.row_number().over(Window.partitionBy("detail_id").orderBy(*AD.LINEITEM_ARRIVAL)).cast("long")
    at = F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("et"))
    rows = details(spark, sf_dir).select("detail_id", place.alias("arrival"), at.alias("at_ms"), *_AMTS)
    done = retract_with_ttl(rows, ["detail_id"], "arrival", _AMTS, "at_ms", _TTL_RETRACT)
    return done.select("detail_id", "arrival", *[F.col(a).cast("double").alias(a) for a in _AMTS], "is_retract")


# Runs of letters of all documents cut by longest match with the words of the benchmark; each
# distinct run is cut once.
_LETTERS = "[a-z\u00e0-\u00ff]+"


@register("segment_longest", f"""
WITH RECURSIVE words AS (SELECT DISTINCT w FROM (SELECT unnest(regexp_extract_all(lower(text), '{_LETTERS}')) AS w FROM benchmark) t
                         WHERE length(w) > 1),
runs AS (SELECT run, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '{_LETTERS}')) AS run FROM documents) t GROUP BY run),
lens AS (SELECT DISTINCT length(w) AS l FROM words),
cand AS (SELECT run, pos, l, substr(run, pos, l) AS w FROM (SELECT run, unnest(range(1, length(run) + 1)) AS pos FROM runs) r, lens
         WHERE pos + l - 1 <= length(run)),
longest AS (SELECT run, pos, max(l) AS l FROM cand SEMI JOIN words USING (w) GROUP BY run, pos),
step AS (SELECT run, n, 1::BIGINT AS pos, 0::BIGINT AS l FROM runs
         UNION ALL SELECT s.run, s.n, s.pos + s.l, coalesce(x.l, 1) FROM (SELECT * FROM step WHERE pos + l <= length(run)) s
         LEFT JOIN longest x ON x.run = s.run AND x.pos = s.pos + s.l)
SELECT substr(run, pos, l) AS word, CAST(sum(n) AS BIGINT) AS n FROM step WHERE l > 0 GROUP BY 1
""")
def q_segment_longest(spark, sf_dir):
    return _segmented(spark, sf_dir, "longest")


def _segmented(spark, sf_dir, mode: str):
    letters = lambda t: F.regexp_extract_all(F.lower(t), F.lit(f"({_LETTERS})"))
    words = AD.load(spark, sf_dir, "benchmark").select(F.explode(letters("text")).alias("word")).where("length(word) > 1")
    runs = AD.load(spark, sf_dir, "documents").select(F.explode(letters("text")).alias("run")).groupBy("run").agg(F.count("*").alias("n"))
    dictionary = words.groupBy("word").agg(F.count("*").alias("weight"))
    cut = segment(runs, "run", dictionary, pattern=_LETTERS, mode=mode)
    return cut.select(F.explode("words").alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n"))


# X2 along the best path: from a run's end to its beginning the best score of what follows each place,
# then forward along the words chosen.
@register("segment_best", f"""
WITH RECURSIVE tokens AS (SELECT unnest(regexp_extract_all(lower(text), '{_LETTERS}')) AS w FROM benchmark),
words AS (SELECT w, ln(count(*) / (SELECT count(*) FROM tokens WHERE length(w) > 1)) AS lw FROM tokens WHERE length(w) > 1 GROUP BY w),
alone AS (SELECT ln(0.5 / count(*)) AS lw FROM tokens WHERE length(w) > 1),
runs AS (SELECT run, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '{_LETTERS}')) AS run FROM documents) t GROUP BY run),
lens AS (SELECT DISTINCT length(w) AS l FROM words),
places AS (SELECT run, unnest(range(1, length(run) + 1)) AS pos FROM runs),
cand AS (SELECT run, pos, l, lw FROM (SELECT run, pos, l, substr(run, pos, l) AS w FROM places, lens WHERE pos + l - 1 <= length(run)) c JOIN words USING (w)
         UNION ALL SELECT run, pos, 1, lw FROM places, alone),
opts AS (SELECT run, pos, list(l ORDER BY l) AS ls, list(lw ORDER BY l) AS ws FROM cand GROUP BY run, pos),
back AS (SELECT run, length(run) + 1 AS pos, 0::BIGINT AS l, [0.0::DOUBLE] AS scores FROM runs
         UNION ALL
         SELECT run, pos, ls[i], list_prepend(own[i], scores)
         FROM (SELECT *, len(own) + 1 - list_position(list_reverse(list_transform(own, lambda x: x >= list_max(own) - 1e-12)), true) AS i
               FROM (SELECT b.run, o.pos, o.ls, b.scores, list_transform(o.ls, lambda x, k: o.ws[k] + b.scores[x]) AS own
                     FROM back b JOIN opts o ON o.run = b.run AND o.pos = b.pos - 1) c) d),
chosen AS (SELECT run, pos, l FROM back WHERE l > 0),
step AS (SELECT run, n, 1::BIGINT AS pos, 0::BIGINT AS l FROM runs
         UNION ALL SELECT s.run, s.n, s.pos + s.l, c.l FROM step s JOIN chosen c ON c.run = s.run AND c.pos = s.pos + s.l)
SELECT substr(run, pos, l) AS word, CAST(sum(n) AS BIGINT) AS n FROM step WHERE l > 0 GROUP BY 1
""")
def q_segment_best(spark, sf_dir):
    return _segmented(spark, sf_dir, "best")


# Hold-and-emit-last — the last version of every order-detail id.
@register("keep_last_detail", f"""
WITH d AS (SELECT *, row_number() OVER (PARTITION BY detail_id ORDER BY {', '.join(c + ' DESC' for c in AD.LINEITEM_ARRIVAL)}) AS rd
           FROM {_DETAILS} x)
SELECT detail_id, order_id, sku_id, {', '.join(f'CAST({a} AS DOUBLE) AS {a}' for a in _AMTS)} FROM d WHERE rd = 1
""")
def q_keep_last_detail(spark, sf_dir):
    d = D.keep_last(details(spark, sf_dir), ["detail_id"], AD.LINEITEM_ARRIVAL)
    return d.select("detail_id", "order_id", "sku_id", *[F.col(a).cast("double").alias(a) for a in _AMTS])


# D3: per order, pass a line only if its ship time is later than every earlier line's.
_D3_ORDER = ["l_linenumber", *AD.LINEITEM_ARRIVAL]


@register("dedup_latest_ts", f"""
WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, epoch_ms(l_shipdate) AS ts_ms,
                  max(epoch_ms(l_shipdate)) OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_D3_ORDER)}
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max
           FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ts_ms FROM x WHERE prev_max IS NULL OR ts_ms > prev_max
""")
def q_dedup_latest_ts(spark, sf_dir):
    li = AD.load(spark, sf_dir, "lineitem").withColumn(
        "ts_ms", F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), "l_shipdate"))
    place = F.col("l_linenumber") * 100_000 + F.datediff("l_shipdate", F.lit("1970-01-01").cast("date"))
    out = D.monotone_latest(li, ["l_orderkey"], _D3_ORDER, "ts_ms", arrival=place)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "ts_ms")


# Exact duplicate records dropped.
@register("dedup_full", "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem")
def q_dedup_full(spark, sf_dir):
    li = AD.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return D.exact_dedup(li)


def _dedup_lines(spark, sf_dir):
    return AD.load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), "l_shipdate").alias("ts_ms"),
        "l_linenumber", *AD.LINEITEM_ARRIVAL)


# First record per (order id, ts) in arrival order (exact form of the Bloom filter).
@register("dedup_key", f"""
WITH x AS (SELECT l_orderkey AS order_id, epoch_ms(l_shipdate) AS ts_ms, l_linenumber, l_partkey,
                  row_number() OVER (PARTITION BY l_orderkey, l_shipdate ORDER BY {_ARR}) AS rn FROM lineitem)
SELECT order_id, ts_ms, l_linenumber, l_partkey FROM x WHERE rn = 1
""")
def q_dedup_key(spark, sf_dir):
    out = D.dedup_on_keys(_dedup_lines(spark, sf_dir), ["order_id", "ts_ms"], AD.LINEITEM_ARRIVAL)
    return out.select("order_id", "ts_ms", "l_linenumber", "l_partkey")


# D5 with a filter: the lines of a second delivery (the fifth line of an order and later) whose order
# and time the first delivery did not have.
@register("bloom_dedup_key", f"""
WITH x AS (SELECT l_orderkey AS order_id, epoch_ms(l_shipdate) AS ts_ms, l_linenumber, {_ARR} FROM lineitem),
n AS (SELECT *, row_number() OVER (PARTITION BY order_id, ts_ms ORDER BY {_ARR}) AS rn FROM x WHERE l_linenumber > 4)
SELECT order_id, ts_ms, l_linenumber, l_partkey FROM n
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM x s WHERE s.l_linenumber <= 4 AND s.order_id = n.order_id AND s.ts_ms = n.ts_ms)
""")
def q_bloom_dedup_key(spark, sf_dir):
    lines = _dedup_lines(spark, sf_dir)
    late = F.col("l_linenumber") > 4
    n = max(1000, lines.where(~late).count())
    out = bloom_dedup(lines.where(late), lines.where(~late), ["order_id", "ts_ms"], AD.LINEITEM_ARRIVAL, n)
    return out.select("order_id", "ts_ms", "l_linenumber", "l_partkey")


# An aggregate of one's own, mergeable quantiles of stay times with a relative error of 1 %.
_Q = (0.5, 0.9, 0.99)


@register("stay_time_quantiles", f"""
WITH v AS (SELECT terminal_type, visit_object_type, CAST(stay_time AS DOUBLE) AS x FROM {AD.SQL('ods')} o
           WHERE tbl = 'ods_user_visit_log' AND op <> 't'),
b AS (SELECT terminal_type, visit_object_type, CASE WHEN x <= 0 THEN -2147483648 ELSE CAST(ceil(ln(x) / ln(1.01 / 0.99)) AS BIGINT) END AS i,
             count(*) AS n FROM v WHERE x IS NOT NULL GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY terminal_type, visit_object_type ORDER BY i) AS upto,
             sum(n) OVER (PARTITION BY terminal_type, visit_object_type) AS total FROM b)
SELECT terminal_type, visit_object_type,
       {', '.join(f"round((SELECT CASE WHEN m = -2147483648 THEN 0.0 ELSE 2 * pow(1.01 / 0.99, m) / (1.01 / 0.99 + 1) END FROM (SELECT min(d.i) AS m FROM c d WHERE d.terminal_type = g.terminal_type AND d.visit_object_type = g.visit_object_type AND d.upto >= {q} * d.total) t), 4) AS p{round(q * 100)}" for q in _Q)}
FROM (SELECT DISTINCT terminal_type, visit_object_type FROM v) g
""")
def q_stay_time_quantiles(spark, sf_dir):
    visits = unpack_cdc(envelopes(spark, sf_dir)).where("_table = 'ods_user_visit_log'").select(
        *[F.col("data")[c].alias(c) for c in ("terminal_type", "visit_object_type")], F.col("data")["stay_time"].cast("double").alias("stay_time"))
    found = aggregate(visits, ["terminal_type", "visit_object_type"], ["stay_time"], QuantileSketch("stay_time", _Q), "array<double>", "q")
    return found.select("terminal_type", "visit_object_type", *[F.round(F.get("q", F.lit(i)), 4).alias(f"p{round(p * 100)}") for i, p in enumerate(_Q)])


# salt/bucket assignment with a hot-key override (fixed values: the override map).
HOT_CUSTOMERS = {"customer#000000001": 0, "customer#000000002": 1}


@register("bucket_assign", """
SELECT c_custkey, c_name,
       CASE lower(c_name) WHEN 'customer#000000001' THEN '0000' WHEN 'customer#000000002' THEN '0001'
            ELSE lpad(CAST(CAST(('0x' || right(md5(c_name), 3)) AS INTEGER) % 128 AS VARCHAR), 4, '0') END AS bucket
FROM customer
""")
def q_bucket_assign(spark, sf_dir):
    c = AD.load(spark, sf_dir, "customer")
    return c.select("c_custkey", "c_name", hash_bucket("c_name", 128, HOT_CUSTOMERS).alias("bucket"))


# Data-quality flags over whole document texts.
_ALLOWED = r"[\p{L}\p{N}\p{P}\p{Zs}\n\r\t]*"


@register("quality_filter", f"""
SELECT doc_id, lang, text IS NULL OR regexp_full_match(text, '[\\x00-\\x20]*') AS is_blank,
       coalesce(regexp_full_match(text, '{_ALLOWED}'), false) AS allowed_chars
FROM documents
""")
def q_quality_filter(spark, sf_dir):
    d = AD.load(spark, sf_dir, "documents")
    return d.select("doc_id", "lang", is_blank("text").alias("is_blank"),
                    F.coalesce(matches_allowed("text", "^" + _ALLOWED + "$"), F.lit(False)).alias("allowed_chars"))


# K6 + F22: day partition from a time that is seconds on even ids and ms on odd ids, missing -> error bucket.
_K6_T = "CASE WHEN k = 3 THEN NULL WHEN event_id % 2 = 0 THEN ts_ms // 1000 ELSE ts_ms END"


@register("day_partition_sink", f"""
SELECT event_id, {_K6_T} AS t,
       coalesce(strftime(make_timestamp(CASE WHEN {_K6_T} < 10000000000 THEN {_K6_T} * 1000 ELSE {_K6_T} END * 1000), '%Y%m%d'),
                'error_bucket') AS day
FROM {_BASE} b
""")
def q_day_partition_sink(spark, sf_dir):
    e = _events(spark, sf_dir).selectExpr("event_id", f"{_K6_T.replace('//', 'div')} AS t")
    return K.day_partition(e, "t")


# K5: upsert of a second batch of orders into the first; only the status is updated on conflict.
_T_CUR = "(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')"
_T_NEW = ("(SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderdate "
          "FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')")


@register("upsert_merge", f"""
SELECT coalesce(c.o_orderkey, n.o_orderkey) AS o_orderkey,
       CASE WHEN c.o_orderkey IS NOT NULL THEN c.o_custkey ELSE n.o_custkey END AS o_custkey,
       CASE WHEN n.o_orderkey IS NOT NULL THEN n.o_orderstatus ELSE c.o_orderstatus END AS o_orderstatus,
       CASE WHEN c.o_orderkey IS NOT NULL THEN c.o_totalprice ELSE n.o_totalprice END AS o_totalprice,
       strftime(CASE WHEN c.o_orderkey IS NOT NULL THEN c.o_orderdate ELSE n.o_orderdate END, '%Y-%m-%d') AS o_orderdate
FROM {_T_CUR} c FULL OUTER JOIN {_T_NEW} n ON c.o_orderkey = n.o_orderkey
""")
def q_upsert_merge(spark, sf_dir):
    o = AD.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    cur = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    new = (o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
           .withColumn("o_orderstatus", F.lit("U")).withColumn("o_totalprice", F.col("o_totalprice") * 2))
    m = K.upsert_merge(cur, new, ["o_orderkey"], ["o_orderstatus"], order=["o_orderdate"])
    return m.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


# K8: delete the orders of customers with a negative balance.
@register("delete_by_keys", """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal < 0 AND c.c_custkey = o.o_custkey)
""")
def q_delete_by_keys(spark, sf_dir):
    o = AD.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    keys = AD.load(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return K.delete_keys(o, keys, ["o_custkey"])


# T4: newest orders (a top-k report: the limit is the feature).
@register("newest_orders", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderstatus FROM orders
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 100
""")
def q_newest_orders(spark, sf_dir):
    o = AD.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return newest_n(o, "o_orderdate", 100, tie=["o_orderkey"]).select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderstatus")


# Table row counts.
_ALL = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
        "embeddings", "pages", "benchmark", "labels", "conversations"]


@register("table_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM {t}" for t in _ALL))
def q_table_row_counts(spark, sf_dir):
    from functools import reduce
    parts = [AD.load(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(t).alias("table_name"), "row_count") for t in _ALL]
    return reduce(lambda a, b: a.unionByName(b), parts)


# K4 + F16 + F21: window results as beans (camelCase) loaded as snake_case JSON lines.
_PV_COLS = ["stt", "edt", "cur_date", "vc", "ch", "ar", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum"]


@register("olap_json_lines",
          "WITH pv AS (" + ORACLE["page_view_window"] + ") SELECT to_json({"
          + ", ".join(f"'{c}': {c}" for c in _PV_COLS) + "}) AS value FROM pv")
def q_olap_json_lines(spark, sf_dir):
    from ..functions.keys import rename_columns
    beans = rename_columns(q_page_view_window(spark, sf_dir).select(*_PV_COLS), "camel")
    return K.json_lines(beans, snake=True)


# S5 + P17 + X1 + A7 in SQL: the keyword job as the reference writes it (a DDL
# topic table, a SQL filter on the page map, a lateral word table, a tumbling
# GROUP BY), on a search topic built from documents joined to events by id.
def _search_topic(s, d):
    docs = AD.load(s, d, "documents").select("doc_id", "text")
    ev = AD.events_base(AD.load(s, d, "events")).select(F.col("event_id").alias("doc_id"), "ts_ms")
    page = F.create_map(F.lit("last_page_id"), F.lit("search"), F.lit("item_type"), F.lit("keyword"),
                        F.lit("item"), F.col("text"))
    return docs.join(ev, "doc_id").select(F.to_json(F.struct(page.alias("page"), F.col("ts_ms").alias("ts")))
                                          .alias("value"))


_KEYWORD_SQL = r"""
SELECT date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
       date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
       date_format(window.start, 'yyyyMMdd') AS cur_date, keyword, count(*) AS keyword_count
FROM (
  SELECT keyword, et FROM tidemill_search_log
  LATERAL VIEW explode(filter(split(lower(page['item']), '[^\\p{L}\\p{N}]+'), x -> x != '')) w AS keyword
  WHERE page['last_page_id'] = 'search' AND page['item_type'] = 'keyword' AND page['item'] IS NOT NULL
)
GROUP BY window(et, '3 days'), keyword
"""


@register("keyword_count_sql", ORACLE["keyword_count_3d"])
def q_keyword_count_sql(spark, sf_dir):
    from ..sources import topic_table
    raw = AD.topic(spark, sf_dir, "search_log", _search_topic)
    topic_table(raw, "page map<string,string>, ts long", view="tidemill_search_log", lateness=None,
                wall_clock=True)
    return spark.sql(_KEYWORD_SQL)


# ================================================================ streaming twins
from . import stream_queries  # noqa: E402,F401  registers the stream_* queries
from . import io_queries  # noqa: E402,F401  registers the queries that write and read back
