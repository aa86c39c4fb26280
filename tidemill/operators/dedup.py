"""De-duplication and keyed-state operators, batch form.

Each function reproduces what the reference's per-key state machine emits when
it sees the rows in arrival order (``order``), without TTL (the batch answer;
the streaming twins in :mod:`tidemill.streaming.stateful` take a TTL).
All are skew-safe: see :mod:`tidemill.operators.keyed`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.time import days_since_date, ms_to_date_str
from .keyed import _null_safe_join, keyed_is_last, keyed_lag, keyed_prefix_max

__all__ = ["retract_duplicates", "keep_last", "monotone_latest", "exact_dedup", "dedup_on_keys",
           "repair_new_visitor", "daily_unique", "daily_unique_pairs", "daily_login",
           "latest_non_null"]


def retract_duplicates(df: DataFrame, ids: Sequence[str], order: Sequence[str | Column],
                       amounts: Sequence[str], flag: str = "is_retract") -> DataFrame:
    """D1 retract-and-correct: when an id repeats, the previous record is emitted
    again with its amounts negated, followed by the new record.

    In batch this is: every row, plus a negated copy of every row that is not
    the last of its id (the copy keeps the old row's fields, so it lands in the
    old row's window and nets it to zero).  One exchange by id: a window tells
    the last row, and a row that is not last is exploded into itself and its copy.
    """
    marked = keyed_is_last(df, ids, order, "__is_last")
    row = F.struct(*[F.col(c) for c in df.columns], F.lit(0).alias(flag))
    copy = F.struct(*[(-F.col(c)).cast(df.schema[c].dataType).alias(c) if c in amounts else F.col(c) for c in df.columns],
                    F.lit(1).alias(flag))
    both = F.when(F.col("__is_last"), F.array(row)).otherwise(F.array(row, copy))
    return marked.select(F.explode(both).alias("__row")).select("__row.*")


def _ranked_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key; planned as a group limit before the exchange."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def keep_last(df: DataFrame, ids: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """D2 hold-and-emit-last: one row per id, the one greatest in ``order``."""
    return _ranked_first(df, ids, [(F.col(o) if isinstance(o, str) else o).desc() for o in order])


def monotone_latest(df: DataFrame, key: Sequence[str], order: Sequence[str | Column],
                    ts: str = "ts_ms", hot_rows: int | None = None, arrival: str | Column | None = None) -> DataFrame:
    """D3: pass a row only if ``ts`` is greater than every earlier ``ts`` of its key."""
    m = keyed_prefix_max(df, key, order, ts, hot_rows, out="__prev_max", arrival=arrival)
    return m.where(F.col("__prev_max").isNull() | (F.col(ts) > F.col("__prev_max"))).drop("__prev_max")


def exact_dedup(df: DataFrame) -> DataFrame:
    """Drop records identical in every column (hash aggregate, map-side combined)."""
    return df.dropDuplicates()


def dedup_on_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """D5 (exact form of the Bloom filter): first row per ``keys`` in arrival order."""
    return _ranked_first(df, keys, [F.col(o) if isinstance(o, str) else o for o in order])


def repair_new_visitor(df: DataFrame, mid: str, order: Sequence[str | Column], ts_ms: str = "ts",
                       is_new: str = "is_new", tz: str = "UTC", out: str | None = None) -> DataFrame:
    """The first record of a device fixes its "first visit date": its own date
    when it says ``is_new='1'``, else the day before.  Any later ``is_new='1'``
    record on another date is corrected to ``'0'``.
    """
    out = out or is_new
    day = F.datediff(ms_to_date_str(ts_ms, tz).cast("date"), F.lit("1970-01-01").cast("date"))
    # fixed-width buffers (a day number by the least arrival) keep this a hash aggregate
    at = F.col(order[0]) if isinstance(order[0], str) else order[0]
    by = at if len(order) == 1 else F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    state = df.groupBy(mid).agg(F.min_by(day - F.when(F.col(is_new) == "1", 0).otherwise(1), by).alias("__first_day"))
    j = _null_safe_join(df, state, [mid])
    fixed = F.when((F.col(is_new) == "1") & (F.col("__first_day") != day), F.lit("0")).otherwise(F.col(is_new))
    cols = [fixed.alias(out) if c == out else F.col(c) for c in df.columns]
    if out not in df.columns:
        cols.append(fixed.alias(out))
    return j.select(*cols)


def daily_unique(df: DataFrame, key: Sequence[str], order: Sequence[str | Column], ts_ms: str = "ts",
                 out: str = "uv_ct", tz: str = "UTC", hot_rows: int | None = None) -> DataFrame:
    """``out`` = 1 when the key's previous record (arrival order) is on
    another date or there is none, else 0 (state = last visit date)."""
    d = df.withColumn("__date", ms_to_date_str(ts_ms, tz))
    lagged = keyed_lag(d, key, order, ["__date"], hot_rows)
    flag = (F.col("__date_prev").isNull() | (F.col("__date_prev") != F.col("__date"))).cast("long")
    return lagged.select(*[F.col(c) for c in df.columns], flag.alias(out))


def daily_unique_pairs(df: DataFrame, mid: str, page: str, order: Sequence[str | Column],
                       gates: dict[str, str], ts_ms: str = "ts", tz: str = "UTC",
                       hot_rows: int | None = None) -> DataFrame:
    """One independent daily gate per (device, page) for each page in ``gates``
    (page value -> output column); rows where no gate fires are dropped."""
    g = daily_unique(df.where(F.col(page).isin(list(gates))), [mid, page], order, ts_ms,
                     "__fire", tz, hot_rows)
    outs = [F.when((F.col(page) == p) & (F.col("__fire") == 1), 1).otherwise(0).cast("long").alias(o)
            for p, o in gates.items()]
    res = g.select("*", *outs).drop("__fire")
    return res.where(sum((F.col(o) for o in gates.values()), F.lit(0)) > 0)


def daily_login(df: DataFrame, uid: str, order: Sequence[str | Column], ts_ms: str = "ts",
                back_days: int = 8, tz: str = "UTC", hot_rows: int | None = None) -> DataFrame:
    """``uu_ct`` = first login of the day; ``back_ct`` = that login comes
    ``back_days`` or more whole days after the previous login date.  Only rows
    with ``uu_ct = 1`` are emitted (as in the reference)."""
    d = df.withColumn("__date", ms_to_date_str(ts_ms, tz))
    lagged = keyed_lag(d, [uid], order, ["__date"], hot_rows)
    uu = F.col("__date_prev").isNull() | (F.col("__date_prev") != F.col("__date"))
    back = F.col("__date_prev").isNotNull() & uu & (days_since_date(ts_ms, "__date_prev", tz) >= back_days)
    res = lagged.select(*[F.col(c) for c in df.columns], uu.cast("long").alias("uu_ct"),
                        back.cast("long").alias("back_ct"))
    return res.where((F.col("uu_ct") == 1) | (F.col("back_ct") == 1))


def latest_non_null(df: DataFrame, key: Sequence[str], order: str | Column,
                    columns: Sequence[str], skip_op: str | None = None) -> DataFrame:
    """One row per key; each column is its latest non-null value
    (an upsert that keeps the old value when the new one is null).
    ``skip_op``: name of a CDC op column whose ``'d'`` rows are ignored."""
    src = df.where(F.col(skip_op) != "d") if skip_op else df
    o = F.col(order) if isinstance(order, str) else order
    return src.groupBy(*key).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), o)).alias(c)
                                   for c in columns])
