"""Pipeline R ("retailer"): app log -> split topics -> windowed DWS results.

Each job is a ``DataFrame -> DataFrame`` function over already-parsed records
(batch form).  Event times are epoch ms (``ts``); ``arrival`` is the topic order
(the offset), which is the order the reference's keyed state sees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import is_empty, word_tokens
from ..functions.time import ms_to_wall
from ..operators import aggregate as A
from ..operators.dedup import (daily_login, daily_unique, daily_unique_pairs, repair_new_visitor,
                               retract_duplicates)
from ..operators.enrich import lookup, snowflake_chain

__all__ = ["flatten_page", "page_view_job", "home_detail_job", "login_job", "cart_job",
           "new_visitor_job", "keyword_job", "sku_order_job", "province_order_job", "retractions"]


def flatten_page(page_stream: DataFrame) -> DataFrame:
    """Page-stream records as flat columns."""
    return page_stream.select(
        "arrival", F.col("common.mid").alias("mid"), F.col("common.uid").alias("uid"),
        F.col("common.vc").alias("vc"), F.col("common.ch").alias("ch"), F.col("common.ar").alias("ar"),
        F.col("common.is_new").alias("is_new"), F.col("page.page_id").alias("page_id"),
        F.col("page.last_page_id").alias("last_page_id"), F.col("page.during_time").alias("during_time"),
        F.col("ts"))


def page_view_job(pages: DataFrame, size: str = "10 seconds", tz: str = "UTC",
                  hot_rows: int | None = None) -> DataFrame:
    """D7 + A6: per (vc, ch, ar, is_new) and 10 s event window — unique visitors
    (first page of a device per day), sessions (no last page), page views, duration."""
    beans = daily_unique(pages.select("arrival", "mid", "vc", "ch", "ar", "is_new", "last_page_id",
                                      "during_time", "ts"),
                         ["mid"], ["arrival"], "ts", "uv_ct", tz, hot_rows)
    beans = beans.select("vc", "ch", "ar", "is_new", "uv_ct",
                         is_empty("last_page_id").cast("long").alias("sv_ct"),
                         F.lit(1).cast("long").alias("pv_ct"),
                         F.coalesce("during_time", F.lit(0)).alias("during_time"),
                         ms_to_wall("ts").alias("et"))
    return A.page_view_window(beans, "et", size)


def home_detail_job(pages: DataFrame, size: str = "5 seconds", tz: str = "UTC",
                    hot_rows: int | None = None) -> DataFrame:
    """P15 + D8 + A4: daily-unique home and good_detail visitors per 5 s window."""
    fired = daily_unique_pairs(pages.select("arrival", "mid", "page_id", "ts"), "mid", "page_id",
                               ["arrival"], {"home": "home_uv_ct", "good_detail": "good_detail_uv_ct"},
                               "ts", tz, hot_rows)
    fired = fired.withColumn("et", ms_to_wall("ts"))
    return A.global_sum_window(fired, "et", size, {"home_uv_ct": "home_uv_ct",
                                                   "good_detail_uv_ct": "good_detail_uv_ct"})


def login_job(pages: DataFrame, size: str = "1 second", tz: str = "UTC", back_days: int = 8,
              hot_rows: int | None = None, time_col: str = "ts") -> DataFrame:
    """P16 + D10 + A5: logins (uid set, coming from the login page or starting a
    session), daily-unique and returning (>= 8 days) users per 1 s window of
    arrival (processing) time; ``time_col`` is the ms column used as that time."""
    logins = pages.where(~is_empty("uid") & ((F.col("last_page_id") == "login") | is_empty("last_page_id")))
    beans = daily_login(logins.select("arrival", "uid", "ts"), "uid", ["arrival"], "ts", back_days, tz, hot_rows)
    beans = beans.withColumn("pt", ms_to_wall(time_col))
    return A.global_sum_window(beans, "pt", size, {"back_ct": "back_ct", "uu_ct": "uu_ct"})


def cart_job(cart_adds: DataFrame, size: str = "5 seconds", tz: str = "UTC",
             hot_rows: int | None = None) -> DataFrame:
    """D9 + A3: daily-unique cart users counted per 5 s window (arrival time)."""
    g = daily_unique(cart_adds.select("arrival", "user_id", "ts"), ["user_id"], ["arrival"], "ts",
                     "__uu", tz, hot_rows)
    g = g.where(F.col("__uu") == 1).withColumn("pt", ms_to_wall("ts"))
    return A.global_count_window(g, "pt", size, "cart_add_uu_ct")


def new_visitor_job(pages: DataFrame, tz: str = "UTC") -> DataFrame:
    """D6 on the page log: corrected ``is_new`` per record."""
    return repair_new_visitor(pages.select("arrival", "mid", "is_new", "ts"), "mid", ["arrival"], "ts",
                              "is_new", tz, out="is_new_fixed")


def keyword_job(searches: DataFrame, size: str = "3 days") -> DataFrame:
    """P17 + X1 + A7 over a table with a ``page`` map and ``et`` event time:
    keyword searches, split into words (whole text), counted per 3-day window."""
    p = F.col("page")
    kw = searches.where((p["last_page_id"] == "search") & (p["item_type"] == "keyword") & p["item"].isNotNull())
    words = kw.select(F.explode(word_tokens(p["item"])).alias("keyword"), "et")
    return A.keyword_window(words, "et", size)


def retractions(details: DataFrame, order: list[str]) -> DataFrame:
    """D1 on order details keyed by ``detail_id`` (four amounts negated)."""
    return retract_duplicates(details, ["detail_id"], order,
                              ["split_original_amount", "split_activity_amount", "split_coupon_amount",
                               "split_total_amount"])


def sku_order_job(details: DataFrame, order: list[str], links, size: str = "5 seconds") -> DataFrame:
    """D1 + A1 + J2: retract-corrected sku amounts per 5 s window, then the
    dimension chain on the (small) aggregated result — aggregate before join."""
    agg = A.sku_order_window(retractions(details, order), "et", size)
    return snowflake_chain(agg, links)


def province_order_job(details: DataFrame, order: list[str], province_dim: DataFrame,
                       size: str = "10 seconds", province_of=None) -> DataFrame:
    """D1 + A2 + J3: order amount and distinct orders per province and 10 s window.
    ``province_of`` adds ``province_id`` to details that lack it, after they are corrected."""
    d = retract_duplicates(details, ["detail_id"], order, ["split_total_amount"])
    d = province_of(d) if province_of else d
    agg = A.province_order_window(d, "et", size)
    return lookup(agg, province_dim, "province_id", "id", {"name": "province_name"})
