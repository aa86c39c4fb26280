"""J1 and J4 inside a running stream: dimension rows join each micro-batch, and are read again once the
copy is older than a period (the cache expiry of a lookup), so later records see what changed since.

The copy is Spark's own persisted frame, one for all executors, in memory as far as it fits and on
their disks beyond; the join is planned for each micro-batch from its measured size.  A record
without a match gets ``missing``; with ``missing=None`` it keeps nulls.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.enrich import lookup
from .jobs import start

__all__ = ["DimensionCopy", "lookup_stream"]


class DimensionCopy:
    """A dimension as last read: ``current()`` reads it again when ``period_s`` seconds have gone by."""

    def __init__(self, read: Callable[[], DataFrame], period_s: float = 600.0, clock: Callable[[], float] = time.time):
        self.read, self.period_s, self.clock = read, period_s, clock
        self._rows: DataFrame | None = None
        self._at = 0.0
        self.reads = 0

    def current(self) -> DataFrame:
        now = self.clock()
        if self._rows is None or now - self._at >= self.period_s:
            rows = self.read().persist(StorageLevel.MEMORY_AND_DISK)
            rows.count()  # the copy is as of now, not as of its first use
            self.close()
            self._rows, self._at = rows, now
            self.reads += 1
        return self._rows

    def close(self) -> None:
        if self._rows is not None:
            self._rows.unpersist()
            self._rows = None


def lookup_stream(stream: DataFrame, dimension: DimensionCopy, key: str, dim_key: str, columns: dict[str, str], path: str, name: str,
                  missing: str | None = "N/A", trigger: dict | None = None) -> tuple[StreamingQuery, str]:
    """Append the enriched records under ``path``, a part for each batch (a repeated batch writes its part
    again); ``columns`` maps the dimension's columns to names in the result.  (query, path)."""

    def write(batch: DataFrame, number: int) -> None:
        rows = lookup(batch, dimension.current(), key, dim_key, columns)
        if missing is not None:
            rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit(missing)) for c in columns.values()})
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return start(stream.sparkSession, stream, name, foreach_batch=write, trigger=trigger), path
