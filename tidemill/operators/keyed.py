"""Skew-safe per-key sequence primitives.

The reference keeps one state value per key and updates it record by record in
arrival order.  In batch that is "the previous row of the same key": a window per
key, one exchange.  A key that holds a large part of all rows would put them in
one task, so each primitive first counts rows by ``BUCKETS`` hashes of the key (map-side
combined, so a task holds that many counts and not one a key), then by key within the
buckets that may have a key with more than ``hot_rows`` rows
(``spark.tidemill.hotRows``).  Without any, the plain window is the plan.  Rows of
hot keys are cut into segments of arrival, windowed per ``(key, segment)``, and
only the first row of a segment is patched from the segments before; rows of all
other keys stay on the plain window and are never joined.

Everything is DataFrame API: window functions, partial aggregation and joins
planned by Catalyst/AQE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

__all__ = ["HOT_ROWS", "keyed_lag", "keyed_prefix_max", "keyed_is_last", "arrival_number", "dealt"]

#: Rows of one key that one task may hold; ``spark.tidemill.hotRows`` overrides it.
HOT_ROWS = 1 << 20
#: Hashes of keys that rows are counted by before any key is.
BUCKETS = 1 << 16
#: Rows that a task gets of tables dealt by rows.
TASK_ROWS = 1 << 20


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def arrival_number(df: DataFrame, arrival: str | Column) -> Column:
    """A number that never falls along the arrival order: the arrival itself, or the leading
    20 digits (the time) of a sortable string."""
    a = F.col(arrival) if isinstance(arrival, str) else arrival
    kind = df.select(a).schema[0].dataType.simpleString()
    return F.substring(a, 1, 20).cast("long") if kind == "string" else a.cast("double")


def dealt(df: DataFrame, rows: int, keys: Sequence[str], most: int | None = None) -> DataFrame:
    """``df`` (of about ``rows`` rows) dealt by ``keys`` with at most about ``most`` rows a task.  AQE merges
    partitions by their compressed bytes, so that rows which compress well make large tasks; small
    tables are left to it."""
    most = most or TASK_ROWS
    if rows <= 8 * most:
        return df
    return df.repartition(max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // most)), *keys)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [left[k].eqNullSafe(right[f"__r_{k}"]) for k in keys]


def _right(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in df.columns])


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` treating null = null (state keyed by a null key is still a key)."""
    r = _right(right, keys)
    return left.join(r, _same(left, r, keys), how).drop(*[f"__r_{k}" for k in keys])


def _split_hot(df: DataFrame, keys: list[str], arrival: Column, hot_rows: int | None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys with ``__seg``); the second is None without hot keys."""
    if hot_rows is None:
        hot_rows = int(df.sparkSession.conf.get("spark.tidemill.hotRows", str(HOT_ROWS)))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
    full = df.groupBy(bucket.alias("__bucket")).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > hot_rows).select("__bucket")
    if full.isEmpty():
        return df, None
    stat = (df.join(full, bucket == F.col("__bucket"), "left_semi").groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("__n"), F.min(arrival).alias("__lo"), F.max(arrival).alias("__hi"))
            .where(F.col("__n") > hot_rows))
    if stat.isEmpty():
        return df, None
    hot = _right(stat, keys)
    cold = df.join(hot, _same(df, hot, keys), "left_anti")
    share = (arrival - F.col("__lo")) / (F.col("__hi") - F.col("__lo") + 1)
    rows = df.join(hot, _same(df, hot, keys)).withColumn("__seg", F.floor(share * F.ceil(F.col("__n") / hot_rows)).cast("long"))
    return cold, rows.select(*df.columns, "__seg")


def keyed_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              values: Sequence[str], hot_rows: int | None = None, suffix: str = "_prev",
              arrival: str | Column | None = None) -> DataFrame:
    """Add ``<v><suffix>``: value of ``v`` in the previous row of the same key.

    ``order`` must be a total order within a key (the arrival order); ``arrival`` is a column
    that never falls along it (default: the first of ``order``).
    """
    keys, values, order_c = list(keys), list(values), _cols(order)
    cold, hot = _split_hot(df, keys, arrival_number(df, order_c[0] if arrival is None else arrival), hot_rows)
    w = Window.partitionBy(*keys).orderBy(*order_c)
    plain = cold.select("*", *[F.lag(v).over(w).alias(v + suffix) for v in values])
    if hot is None:
        return plain
    ws = Window.partitionBy(*keys, "__seg").orderBy(*order_c)
    inner = hot.select("*", F.row_number().over(ws).alias("__rn"), F.lead(F.lit(1)).over(ws).isNull().alias("__tail"),
                       *[F.lag(v).over(ws).alias(f"__lag_{v}") for v in values])
    tails = inner.where("__tail").select(*keys, "__seg", *[F.col(v).alias(f"__last_{v}") for v in values])
    wt = Window.partitionBy(*keys).orderBy("__seg")
    carry = tails.select(*keys, "__seg", *[F.lag(f"__last_{v}").over(wt).alias(f"__carry_{v}") for v in values])
    joined = _null_safe_join(inner, carry, [*keys, "__seg"])
    split = joined.select(*df.columns, *[F.when(F.col("__rn") == 1, F.col(f"__carry_{v}")).otherwise(F.col(f"__lag_{v}"))
                                         .alias(v + suffix) for v in values])
    return plain.unionByName(split)


def keyed_prefix_max(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                     value: str, hot_rows: int | None = None, out: str = "prev_max",
                     arrival: str | Column | None = None) -> DataFrame:
    """Add ``out``: max of ``value`` over all *earlier* rows of the same key (null if none)."""
    keys, order_c = list(keys), _cols(order)
    cold, hot = _split_hot(df, keys, arrival_number(df, order_c[0] if arrival is None else arrival), hot_rows)
    w = Window.partitionBy(*keys).orderBy(*order_c).rowsBetween(Window.unboundedPreceding, -1)
    plain = cold.select("*", F.max(value).over(w).alias(out))
    if hot is None:
        return plain
    ws = Window.partitionBy(*keys, "__seg").orderBy(*order_c).rowsBetween(Window.unboundedPreceding, -1)
    inner = hot.select("*", F.max(value).over(ws).alias("__inner"))
    tails = hot.groupBy(*keys, "__seg").agg(F.max(value).alias("__segmax"))
    wt = Window.partitionBy(*keys).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select(*keys, "__seg", F.max("__segmax").over(wt).alias("__carry"))
    joined = _null_safe_join(inner, carry, [*keys, "__seg"])
    return plain.unionByName(joined.select(*df.columns, F.greatest(F.col("__carry"), F.col("__inner")).alias(out)))


def keyed_is_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str = "is_last",
                  hot_rows: int | None = None, arrival: str | Column | None = None) -> DataFrame:
    """Add ``out``: whether the row is the last of its key; of rows that tie, exactly one is."""
    keys, order_c = list(keys), _cols(order)
    if arrival is None and df.select(order_c[0]).schema[0].dataType.simpleString() not in ("int", "bigint", "double", "string"):
        arrival = F.unix_seconds(order_c[0].cast("timestamp"))
    cold, hot = _split_hot(df, keys, arrival_number(df, order_c[0] if arrival is None else arrival), hot_rows)
    w = Window.partitionBy(*keys).orderBy(*order_c)
    plain = cold.select("*", F.lead(F.lit(1)).over(w).isNull().alias(out))
    if hot is None:
        return plain
    ws = Window.partitionBy(*keys, "__seg").orderBy(*order_c)
    inner = hot.select("*", F.lead(F.lit(1)).over(ws).isNull().alias("__tail"))
    top = hot.groupBy(*keys).agg(F.max("__seg").alias("__top"))
    joined = _null_safe_join(inner, top, keys)
    return plain.unionByName(joined.select(*df.columns, (F.col("__tail") & (F.col("__seg") == F.col("__top"))).alias(out)))
