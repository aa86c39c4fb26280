"""Top-N per group, newest-N and scan limit.

``top_n`` is exact and skew-safe: rows are first ranked inside
``(group, salt)`` sub-groups and only each sub-group's best ``n`` survive, so a
hot group contributes at most ``n * salt_buckets`` rows to the final ranking.
The global top ``n`` of a group is always inside the union of the sub-groups'
top ``n``, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

__all__ = ["top_n", "newest_n"]


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], n: int,
          rank_col: str = "ranking") -> DataFrame:
    """Keep the first ``n`` rows of each group in ``order`` and number them 1..n.

    ``order`` must be total inside a group (add tie-breakers).  Spark plans a rank filter
    as a group limit before the exchange, so a hot group sends at most ``n`` rows a task.
    """
    w = Window.partitionBy(*group).orderBy(*_cols(order))
    return df.withColumn(rank_col, F.row_number().over(w).cast("long")).where(F.col(rank_col) <= n)


def newest_n(df: DataFrame, time_col: str, n: int, tie: Sequence[str] = ()) -> DataFrame:
    """T4: ``ORDER BY time DESC LIMIT n`` (planned as TakeOrderedAndProject:
    each task keeps its own top n, the driver merges n x tasks rows)."""
    return df.orderBy(F.col(time_col).desc(), *[F.col(t).desc() for t in tie]).limit(n)
