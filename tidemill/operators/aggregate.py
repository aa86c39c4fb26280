"""Tumbling-window aggregates.

Every aggregate is a ``groupBy(window, keys).agg(...)``: Catalyst plans a partial
(map-side) aggregate before the shuffle and a final one after it, which is the
reference's ``AggregateFunction.add``/``merge`` pair.  Global windows (the
reference's ``windowAll``) group by the window only; partial aggregation keeps
that from funnelling raw rows into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import int_div, safe_ratio
from ..functions.time import window_bounds

__all__ = ["tumbling", "sum_long", "sum_money", "sku_order_window", "province_order_window",
           "global_count_window", "global_sum_window", "page_view_window",
           "keyword_window", "ads_traffic_summary", "ads_traffic_source", "ads_keyword",
           "ads_product", "ads_page", "ads_crowd", "MONEY"]

MONEY = "decimal(18,2)"


def sum_long(c: str | Column, name: str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.sum(F.coalesce(col.cast("long"), F.lit(0))).cast("long").alias(name)


def sum_money(c: str | Column, name: str, scale: str = MONEY) -> Column:
    """Exact money sum (order independent), rounded to ``scale`` and emitted as
    double (the rounded value converts exactly the same in every engine).

    Amounts carry at most 4 decimals, so they are summed as whole 1/10000 units
    in a LONG: a fixed-width buffer that stays in the codegen'd hash aggregate
    (a wide DECIMAL sum would fall back to BigDecimal arithmetic).  The one
    division per group is decimal, so rounding is exact HALF_UP.
    """
    col = F.col(c) if isinstance(c, str) else c
    units = (col.cast("decimal(18,4)") * F.lit(10000)).cast("long")
    total = F.sum(units).cast("decimal(38,0)") / F.lit(10000).cast("decimal(38,0)")
    return total.cast(scale).cast("double").alias(name)


def tumbling(df: DataFrame, time_col: str, size: str, keys: Sequence[str | Column],
             aggs: Sequence[Column], bounds: bool = True) -> DataFrame:
    """W7/W8 + W9: tumbling window on ``time_col`` (event or arrival time)."""
    g = df.groupBy(F.window(time_col, size).alias("window"), *keys).agg(*aggs)
    if not bounds:
        return g
    return g.select(*window_bounds("window"), *[c for c in g.columns if c != "window"])


# ---------------------------------------------------------------- pipeline R (DWS)

def sku_order_window(detail: DataFrame, time_col: str = "et", size: str = "5 seconds") -> DataFrame:
    """A1: per sku and window, sums of original / activity / coupon / order amount."""
    return tumbling(detail, time_col, size, ["sku_id"], [
        sum_money("split_original_amount", "original_amount"),
        sum_money("split_activity_amount", "activity_reduce_amount"),
        sum_money("split_coupon_amount", "coupon_reduce_amount"),
        sum_money("split_total_amount", "order_amount"),
    ])


def province_order_window(detail: DataFrame, time_col: str = "et", size: str = "10 seconds",
                          distinct: str = "count") -> DataFrame:
    """A2: per province and window, order amount and *distinct* order count
    (order ids of retraction rows count too, as in the reference).  ``distinct="set"``
    counts the members of a set, the form that streams can keep."""
    orders = F.count_distinct("order_id") if distinct == "count" else F.size(F.collect_set("order_id")).cast("long")
    return tumbling(detail, time_col, size, ["province_id"], [
        orders.alias("order_count"),
        sum_money("split_total_amount", "order_amount"),
    ])


def global_count_window(df: DataFrame, time_col: str, size: str, name: str) -> DataFrame:
    """A3: one count per window (no key)."""
    return tumbling(df, time_col, size, [], [F.count(F.lit(1)).alias(name)])


def global_sum_window(df: DataFrame, time_col: str, size: str, sums: dict[str, str]) -> DataFrame:
    """A4/A5: sums per window (no key); ``sums`` maps input column -> output name."""
    return tumbling(df, time_col, size, [], [sum_long(c, n) for c, n in sums.items()])


def page_view_window(beans: DataFrame, time_col: str = "et", size: str = "10 seconds") -> DataFrame:
    """Per (vc, ch, ar, is_new) and window: uv, session, pv counts and duration."""
    return tumbling(beans, time_col, size, ["vc", "ch", "ar", "is_new"], [
        sum_long("uv_ct", "uv_ct"), sum_long("sv_ct", "sv_ct"),
        sum_long("pv_ct", "pv_ct"), sum_long("during_time", "dur_sum"),
    ])


def keyword_window(words: DataFrame, time_col: str = "et", size: str = "3 days") -> DataFrame:
    """Keyword counts per 3-day window; ``cur_date`` as ``yyyyMMdd``."""
    g = words.groupBy(F.window(time_col, size).alias("window"), "keyword").agg(
        F.count(F.lit(1)).alias("keyword_count"))
    return g.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("stt"),
                    F.date_format("window.end", "yyyy-MM-dd HH:mm:ss").alias("edt"),
                    F.date_format("window.start", "yyyyMMdd").alias("cur_date"),
                    "keyword", "keyword_count")


# ---------------------------------------------------------------- pipeline G (ADS)

def _ads(df: DataFrame, time_col: str, size: str, keys: list[str], aggs: list[Column]) -> DataFrame:
    g = df.groupBy(F.window(time_col, size).alias("window"), *keys).agg(*aggs)
    return g.select(*keys, *[c for c in g.columns if c not in keys and c != "window"],
                    F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                    F.date_format("window.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"))


def _entity(keys: list[str], entity: str, legacy_key: bool) -> tuple[list[str], list[Column]]:
    """The grouping keys with the entity, or (``legacy_key``, as the reference groups) without it, the
    last entity seen standing for the group."""
    return (keys, [F.max_by(entity, "arrival").alias(entity)]) if legacy_key else ([*keys, entity], [])


def write_time(df: DataFrame, name: str) -> DataFrame:
    """The writer's clock as epoch ms: ``summary_time`` of A8, ``analysis_time`` of A12."""
    return df.withColumn(name, F.unix_millis(F.current_timestamp()))


def ads_traffic_summary(dws: DataFrame, time_col: str = "pt", size: str = "1 hour") -> DataFrame:
    """Nine totals per (stat_time, terminal_type, shop_id)."""
    return _ads(dws, time_col, size, ["stat_time", "terminal_type", "shop_id"], [
        sum_long("shop_visitor_count", "total_shop_visitor"), sum_long("shop_page_view", "total_shop_pv"),
        sum_long("new_visitor_count", "total_new_visitor"), sum_long("old_visitor_count", "total_old_visitor"),
        sum_long("product_visitor_count", "total_product_visitor"),
        sum_long("product_page_view", "total_product_pv"),
        sum_long("add_collection_count", "total_add_collection"),
        sum_long("pay_buyer_count", "total_pay_buyer"), sum_money("pay_amount", "total_pay_amount"),
    ])


def ads_traffic_source(dws: DataFrame, time_col: str = "pt", size: str = "1 hour") -> DataFrame:
    """Per (stat_time, terminal, shop, traffic_source) three totals and the
    last seen second-level source."""
    out = _ads(dws, time_col, size, ["stat_time", "terminal_type", "shop_id", "traffic_source_first"], [
        sum_long("visitor_count", "total_visitor"),
        sum_long("product_visitor_count", "total_product_visitor"),
        sum_money("product_pay_amount", "total_product_pay"),
        F.max_by("traffic_source_second", "arrival").alias("traffic_source_second"),
    ])
    return out.withColumnRenamed("traffic_source_first", "traffic_source")


def ads_keyword(dws: DataFrame, time_col: str = "pt", size: str = "1 day", legacy_key: bool = False) -> DataFrame:
    """A10: per keyword, search and click totals and click_rate = click/search."""
    keys, last = _entity(["stat_time", "stat_dimension", "terminal_type", "shop_id"], "keyword", legacy_key)
    out = _ads(dws, time_col, size, keys, [
        *last,
        sum_long("search_visitor_count", "total_search_visitor"),
        sum_long("click_visitor_count", "total_click_visitor"),
    ])
    return out.withColumn("click_rate", safe_ratio("total_click_visitor", "total_search_visitor"))


def ads_product(dws: DataFrame, time_col: str = "pt", size: str = "2 hours", legacy_key: bool = False) -> DataFrame:
    """Per product six totals."""
    keys, last = _entity(["stat_time", "terminal_type", "shop_id"], "product_id", legacy_key)
    return _ads(dws, time_col, size, keys, [
        *last,
        sum_long("visitor_count", "total_visitor"), sum_long("page_view", "total_pv"),
        sum_long("add_cart_count", "total_add_cart"), sum_long("collection_count", "total_collection"),
        sum_long("pay_buyer_count", "total_pay_buyer"), sum_money("pay_amount", "total_pay_amount"),
    ])


def ads_page(dws: DataFrame, time_col: str = "pt", size: str = "1 hour", legacy_key: bool = False) -> DataFrame:
    """Per page visitor, pv, click, summed stay; avg_stay = sum_stay div pv."""
    keys, last = _entity(["stat_time", "terminal_type", "shop_id"], "page_id", legacy_key)
    out = _ads(dws, time_col, size, keys, [
        *last,
        sum_long("visitor_count", "total_visitor"), sum_long("page_view", "total_pv"),
        sum_long("click_count", "total_click"), sum_long("avg_stay_time", "sum_stay_time"),
    ])
    return out.withColumn("avg_stay_time", int_div("sum_stay_time", "total_pv"))


def ads_crowd(dws: DataFrame, time_col: str = "pt", size: str = "1 day") -> DataFrame:
    """Per crowd type the crowd total and the last seen attributes."""
    return _ads(dws, time_col, size, ["stat_time", "terminal_type", "shop_id", "crowd_type"], [
        sum_long("crowd_count", "total_crowd"),
        F.max_by("gender", "arrival").alias("gender"), F.max_by("age_range", "arrival").alias("age_range"),
        F.max_by("city", "arrival").alias("city"), F.max_by("taoqi_value", "arrival").alias("taoqi_value"),
    ])
