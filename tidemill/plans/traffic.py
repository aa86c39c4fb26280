"""Pipeline G ("traffic overview"): change envelopes -> ODS -> DWD -> DWS -> ADS.

Every layer is a ``DataFrame -> DataFrame`` function; in the reference each
layer is a separate process talking through topics, here they compose into one
plan (or are written per layer with :mod:`tidemill.sinks`).  Row images are
``map<string,string>`` (schema-on-read JSON); the DWD cleaners apply the
reference's coercing getters as ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import is_blank
from ..functions.time import ms_to_date_str, ms_to_wall, stat_day_ms, stat_hour_ms
from ..operators import aggregate as A
from ..operators.parse import route_by_table, unpack_cdc
from ..operators.topn import top_n

__all__ = ["ods_records", "flag_new_visitors", "first_seen", "visitor_split", "dwd_user_visit", "dwd_product_interaction", "dwd_order_pay",
           "dwd_search", "dwd_page_click", "dwd_crowd_attribute", "dws_traffic_overview", "dws_traffic_source",
           "dws_keyword", "dws_product_traffic", "dws_page_traffic", "dws_crowd_feature", "SHOP_ID",
           "ads_traffic_summary", "ads_traffic_source_topn", "ads_keyword_topn", "ads_product_topn",
           "ads_page_performance", "ads_crowd_analysis"]

SHOP_ID = 10001  # the reference's literal shop id (ledger Q8); a parameter everywhere


def first_seen(unpacked: DataFrame, vid: str = "__vid", out: str = "__first") -> DataFrame:
    """Add ``vid`` (the row image's visitor id, null without one) and ``out``: whether no earlier
    record (arrival order, any table) carried it.  One map-side combined minimum per id and one
    left join; a null id matches nothing and stays null.  The join is on a hash too, which for rows
    without an id is that of their arrival, so that they don't all meet in one task."""
    data = F.col("data")
    carrying = unpacked.withColumn(vid, F.when(F.map_contains_key(data, "visitor_id"), data["visitor_id"]))
    first = (carrying.where(F.col(vid).isNotNull()).groupBy(F.col(vid).alias("__id")).agg(F.min("arrival").alias("__at")))
    dealt = F.xxhash64(F.coalesce(F.col(vid), F.col("arrival").cast("string")))
    same = (F.col(vid) == F.col("__id")) & (dealt == F.xxhash64("__id"))
    return (carrying.join(first, same, "left")
            .withColumn(out, F.when(F.col("__id").isNotNull(), F.col("arrival") == F.col("__at"))).drop("__id", "__at"))


def flag_new_visitors(unpacked: DataFrame, only_if_present: bool = True) -> DataFrame:
    """U2 (``only_if_present=True``) / U3: a record is a new visitor when no
    earlier record (arrival order, any table) carried its ``visitor_id``.
    U2 overwrites ``is_new_visitor`` only where the row image has that field;
    U3 sets it on every record that has a visitor id."""
    data = F.col("data")
    flag = F.when(F.col("__first"), F.lit("1")).otherwise(F.lit("0"))
    if only_if_present:
        new = F.when(F.col("__first").isNotNull() & F.map_contains_key(data, "is_new_visitor"),
                     F.transform_values(data, lambda k, v: F.when(k == "is_new_visitor", flag).otherwise(v))
                     ).otherwise(data)
    else:
        new = F.when(F.col("__first").isNotNull(),
                     F.map_concat(F.map_filter(data, lambda k, v: k != "is_new_visitor"),
                                  F.create_map(F.lit("is_new_visitor"), flag))).otherwise(data)
    return first_seen(unpacked).withColumn("data", new).drop("__vid", "__first")


def visitor_split(unpacked: DataFrame) -> DataFrame:
    """U2's tagged side streams: every record with a visitor id, ``stream`` = 'new' or 'old'."""
    seen = first_seen(unpacked).where(F.col("__vid").isNotNull())
    return seen.withColumn("stream", F.when(F.col("__first"), "new").otherwise("old")).drop("__vid", "__first")


def ods_records(envelopes: DataFrame, topic_prefix: str = "", flag: bool = True) -> DataFrame:
    """U1 + U2 + P18: unpack, flag new visitors, route to a topic per table.  ``flag=False`` leaves
    U2 out, for readers that do not use ``is_new_visitor``."""
    unpacked = unpack_cdc(envelopes, keep=("arrival",))
    return route_by_table(flag_new_visitors(unpacked) if flag else unpacked, topic_prefix=topic_prefix)


# ---------------------------------------------------------------- DWD
def _g(name: str, dtype: str = "string"):
    v = F.col("data")[name]
    return (v if dtype == "string" else v.try_cast(dtype)).alias(name)


def _topic(ods: DataFrame, table: str, prefix: str = "") -> DataFrame:
    return ods.where(F.col("topic") == prefix + table)


def dwd_user_visit(ods: DataFrame, shop_id: int = SHOP_ID, tz: str = "UTC", prefix: str = "") -> DataFrame:
    """Drop null/blank visitor or null visit time; 11 fields + stat hour + shop."""
    t = _topic(ods, "ods_user_visit_log", prefix)
    t = t.where(~is_blank(F.col("data")["visitor_id"]) & F.col("data")["visit_time"].try_cast("long").isNotNull())
    return t.select("arrival", _g("log_id", "long"), _g("visit_time", "long"), _g("visitor_id"), _g("terminal_type"),
                    _g("visit_object_type"), _g("visit_object_id", "long"), _g("traffic_source_first"),
                    _g("traffic_source_second"), _g("is_new_visitor", "int"), _g("page_view", "int"),
                    _g("stay_time", "int"),
                    stat_hour_ms(F.col("data")["visit_time"].try_cast("long"), tz).alias("stat_time"),
                    F.lit(shop_id).cast("long").alias("shop_id"))


def _timed(ods: DataFrame, table: str, time_field: str, prefix: str) -> DataFrame:
    # a null event time fails the reference's stat computation: the row is dropped
    return _topic(ods, table, prefix).where(F.col("data")[time_field].try_cast("long").isNotNull())


def dwd_product_interaction(ods: DataFrame, shop_id: int = SHOP_ID, tz: str = "UTC", prefix: str = "") -> DataFrame:
    """Drop cancelled interactions (``is_cancel = 1``; null kept)."""
    t = _timed(ods, "ods_product_interaction_log", "interact_time", prefix)
    t = t.where(F.coalesce(F.col("data")["is_cancel"].try_cast("int"), F.lit(0)) != 1)
    return t.select("arrival", _g("log_id", "long"), _g("interact_time", "long"), _g("visitor_id"),
                    _g("terminal_type"), _g("product_id", "long"), _g("interact_type"), _g("is_cancel", "int"),
                    stat_hour_ms(F.col("data")["interact_time"].try_cast("long"), tz).alias("stat_time"),
                    F.lit(shop_id).cast("long").alias("shop_id"))


def dwd_order_pay(ods: DataFrame, shop_id: int = SHOP_ID, tz: str = "UTC", prefix: str = "") -> DataFrame:
    """P5: keep paid orders only (null dropped); amount as string; quantity 1."""
    t = _timed(ods, "ods_order_pay_log", "pay_time", prefix)
    t = t.where(F.col("data")["is_paid"].try_cast("int") == 1)
    return t.select("arrival", _g("log_id", "long"), _g("order_id", "long"), _g("pay_time", "long"), _g("buyer_id"),
                    _g("terminal_type"), _g("product_id", "long"), _g("pay_amount"), _g("is_paid", "int"),
                    F.lit(1).alias("pay_quantity"),
                    stat_hour_ms(F.col("data")["pay_time"].try_cast("long"), tz).alias("stat_time"),
                    F.lit(shop_id).cast("long").alias("shop_id"))


def dwd_search(ods: DataFrame, shop_id: int = SHOP_ID, tz: str = "UTC", prefix: str = "") -> DataFrame:
    """Stat day and ``stat_dimension = 'day'``."""
    t = _timed(ods, "ods_search_log", "search_time", prefix)
    return t.select("arrival", _g("log_id", "long"), _g("search_time", "long"), _g("visitor_id"), _g("terminal_type"),
                    _g("keyword"), _g("is_click_result", "int"), _g("click_product_id", "long"),
                    stat_day_ms(F.col("data")["search_time"].try_cast("long"), tz).alias("stat_time"),
                    F.lit("day").alias("stat_dimension"), F.lit(shop_id).cast("long").alias("shop_id"))


def dwd_page_click(ods: DataFrame, shop_id: int = SHOP_ID, tz: str = "UTC", prefix: str = "") -> DataFrame:
    """Stat hour."""
    t = _timed(ods, "ods_page_click_log", "click_time", prefix)
    return t.select("arrival", _g("log_id", "long"), _g("click_time", "long"), _g("visitor_id"), _g("terminal_type"),
                    _g("page_id", "long"), _g("module_name"), _g("module_position"), _g("guide_product_id", "long"),
                    stat_hour_ms(F.col("data")["click_time"].try_cast("long"), tz).alias("stat_time"),
                    F.lit(shop_id).cast("long").alias("shop_id"))


def dwd_crowd_attribute(ods: DataFrame, shop_id: int = SHOP_ID, tz: str = "UTC", prefix: str = "") -> DataFrame:
    """Stat day; ``city_level`` is not carried."""
    t = _timed(ods, "ods_crowd_attribute_log", "update_time", prefix)
    return t.select("arrival", _g("log_id", "long"), _g("visitor_id"), _g("gender"), _g("age_range"), _g("city"),
                    _g("taoqi_value", "int"), _g("update_time", "long"),
                    stat_day_ms(F.col("data")["update_time"].try_cast("long"), tz).alias("stat_time"),
                    F.lit(shop_id).cast("long").alias("shop_id"))


# ---------------------------------------------------------------- DWS
def _zero_money():
    return F.lit(0).cast("decimal(18,2)")


def dws_traffic_overview(uv: DataFrame) -> DataFrame:
    """Shop vs product metrics by visit object type; new/old split; cart/pay 0 (ledger Q6)."""
    shop = F.col("visit_object_type") == "shop"
    prod = F.col("visit_object_type") == "product"
    one = lambda c: F.when(c, 1).otherwise(0)
    return uv.select("arrival", "stat_time", "terminal_type", "shop_id", "visit_time",
                     one(shop).alias("shop_visitor_count"),
                     F.when(shop, F.col("page_view")).otherwise(0).alias("shop_page_view"),
                     one(shop & (F.col("is_new_visitor") == 1)).alias("new_visitor_count"),
                     one(shop & ~(F.coalesce(F.col("is_new_visitor") == 1, F.lit(False)))).alias("old_visitor_count"),
                     one(prod).alias("product_visitor_count"),
                     F.when(prod, F.col("page_view")).otherwise(0).alias("product_page_view"),
                     F.lit(0).alias("add_collection_count"), F.lit(0).alias("pay_buyer_count"),
                     _zero_money().alias("pay_amount"))


def dws_traffic_source(uv: DataFrame) -> DataFrame:
    """P10: one visitor per record, product-visit flag, empty sub-source list, pay 0."""
    return uv.select("arrival", "stat_time", "terminal_type", "shop_id", "visit_time", "traffic_source_first",
                     "traffic_source_second", F.lit(1).alias("visitor_count"),
                     F.array().cast("array<string>").alias("sub_source_list"),
                     F.col("visit_object_id").alias("related_product_id"),
                     F.when(F.col("visit_object_type") == "product", 1).otherwise(0).alias("product_visitor_count"),
                     _zero_money().alias("product_pay_amount"))


def dws_keyword(search: DataFrame, legacy_stat_time: bool = False) -> DataFrame:
    """Search 1, click = is_click_result; ``stat_time`` as ``yyyy-MM-dd``
    (``legacy_stat_time`` keeps the reference's first 10 digits of the ms value)."""
    st = (F.substring(F.col("stat_time").cast("string"), 1, 10) if legacy_stat_time
          else ms_to_date_str("stat_time"))
    return search.select("arrival", st.alias("stat_time"), "stat_dimension", "terminal_type", "shop_id",
                         "search_time", "keyword", F.lit(1).alias("search_visitor_count"),
                         F.col("is_click_result").alias("click_visitor_count"))


def dws_product_traffic(uv: DataFrame) -> DataFrame:
    """Product visits only."""
    return uv.where(F.col("visit_object_type") == "product").select(
        "arrival", "stat_time", "terminal_type", "shop_id", "visit_time",
        F.col("visit_object_id").alias("product_id"), F.lit(1).alias("visitor_count"), "page_view",
        F.col("stay_time").alias("avg_stay_time"), F.lit(0).alias("add_cart_count"),
        F.lit(0).alias("collection_count"), F.lit(0).alias("pay_buyer_count"), _zero_money().alias("pay_amount"),
        F.array().cast("array<string>").alias("traffic_source_json"))


def dws_page_traffic(uv: DataFrame) -> DataFrame:
    """Page visits only; click count 0."""
    return uv.where(F.col("visit_object_type") == "page").select(
        "arrival", "stat_time", "terminal_type", "shop_id", "visit_time",
        F.col("visit_object_id").alias("page_id"), F.lit(1).alias("visitor_count"), "page_view",
        F.lit(0).alias("click_count"), F.col("stay_time").alias("avg_stay_time"),
        F.array().cast("array<string>").alias("module_click_json"),
        F.array().cast("array<string>").alias("guide_product_json"))


# The three crowd types, the crowd terminal and the constant ratio.
CROWD_TYPES = ["shop_entry", "product_visit", "conversion"]


def dws_crowd_feature(crowd: DataFrame) -> DataFrame:
    """Each record becomes three rows, one per crowd type."""
    return crowd.select("arrival", "stat_time", F.lit("overall").alias("terminal_type"), "shop_id", "update_time",
                        F.explode(F.array(*[F.lit(t) for t in CROWD_TYPES])).alias("crowd_type"),
                        "gender", "age_range", "city", "taoqi_value", F.lit(1).alias("crowd_count"),
                        F.lit(1).alias("total_crowd_count"),
                        F.lit("1.0000").cast("decimal(5,4)").alias("crowd_ratio"))


# ---------------------------------------------------------------- ADS
def _pt(df: DataFrame, time_field: str) -> DataFrame:
    """Processing time of the batch form: the record's own time (ledger Q23)."""
    return df.withColumn("pt", ms_to_wall(time_field))


def ads_traffic_summary(overview: DataFrame) -> DataFrame:
    return A.ads_traffic_summary(_pt(overview, "visit_time"))


def ads_traffic_source_topn(source: DataFrame, n: int = 10) -> DataFrame:
    agg = A.ads_traffic_source(_pt(source, "visit_time"))
    return top_n(agg, ["stat_time", "terminal_type", "shop_id", "window_start"],
                 [F.col("total_visitor").desc(), F.col("traffic_source").asc_nulls_first()], n)


def ads_keyword_topn(keyword: DataFrame, n: int = 20, legacy_key: bool = False) -> DataFrame:
    agg = A.ads_keyword(_pt(keyword, "search_time"), legacy_key=legacy_key)
    return top_n(agg, ["stat_time", "stat_dimension", "terminal_type", "shop_id", "window_start"],
                 [F.col("total_search_visitor").desc(), F.col("keyword").asc_nulls_first()], n)


def ads_product_topn(product: DataFrame, n: int = 15, legacy_key: bool = False) -> DataFrame:
    agg = A.ads_product(_pt(product, "visit_time"), legacy_key=legacy_key)
    return top_n(agg, ["stat_time", "terminal_type", "shop_id", "window_start"],
                 [F.col("total_visitor").desc(), F.col("product_id").asc_nulls_first()], n)


def ads_page_performance(page: DataFrame, legacy_key: bool = False) -> DataFrame:
    return A.ads_page(_pt(page, "visit_time"), legacy_key=legacy_key)


def ads_crowd_analysis(crowd: DataFrame) -> DataFrame:
    return A.ads_crowd(_pt(crowd, "update_time"))
