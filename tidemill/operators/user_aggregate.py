"""Aggregates of one's own, with a buffer that is made, added to, merged and read.

Aggregation has two steps, as Spark's own: each task adds its rows to a buffer per group, in bounded
memory, and hands on one row per group; buffers of a group are then merged, first by sender so that
a group that every task has doesn't come together in one step, then to one.  Only buffers are
shuffled, never rows, and a group may hold any share of them.

Null is a group like others; rows whose values are all null reach ``add`` too, which decides; an
empty table has no groups.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import ship_package

__all__ = ["UserAggregate", "QuantileSketch", "aggregate"]

#: Groups that a task holds buffers of before it hands them on.
HELD_GROUPS = 1 << 14
#: Senders whose buffers of a group are merged together first.
FAN = 64


class UserAggregate:
    """The contract; ``merge`` must not depend on the order or grouping of buffers."""

    def create(self) -> Any:
        raise TypeError("an aggregate says what an empty buffer is")

    def add(self, buffer: Any, rows: pd.DataFrame) -> Any:
        raise TypeError("an aggregate says how rows go into a buffer")

    def merge(self, one: Any, other: Any) -> Any:
        raise TypeError("an aggregate says how two buffers become one")

    def result(self, buffer: Any) -> Any:
        return buffer

    def dump(self, buffer: Any) -> bytes:
        return pickle.dumps(buffer)

    def load(self, data: bytes) -> Any:
        return pickle.loads(data)


class QuantileSketch(UserAggregate):
    """Quantiles with a relative error of at most ``accuracy``: counts of values in buckets that grow by
    a factor.  A value falls into its bucket whoever counts it, so merging adds counts and is exact.

    The quantile ``q`` is the middle of the first bucket up to which at least ``q`` of all values lie.
    Values of zero and less are counted as zero; null and NaN aren't counted; without values, nulls.
    """

    def __init__(self, column: str, quantiles: Sequence[float], accuracy: float = 0.01):
        self.column, self.quantiles = column, list(quantiles)
        self.growth = (1 + accuracy) / (1 - accuracy)

    _ZERO = -(1 << 31)

    def create(self) -> dict[int, int]:
        return {}

    def add(self, buffer, rows):
        x = rows[self.column].to_numpy(dtype=float, na_value=np.nan)
        x = x[~np.isnan(x)]
        at = np.full(len(x), self._ZERO, np.int64)
        at[x > 0] = np.ceil(np.log(x[x > 0]) / math.log(self.growth)).astype(np.int64)
        for bucket, n in zip(*(v.tolist() for v in np.unique(at, return_counts=True))):
            buffer[bucket] = buffer.get(bucket, 0) + n
        return buffer

    def merge(self, one, other):
        for bucket, n in other.items():
            one[bucket] = one.get(bucket, 0) + n
        return one

    def result(self, buffer):
        if not buffer:
            return [None] * len(self.quantiles)
        buckets = sorted(buffer)
        upto, total = np.cumsum([buffer[b] for b in buckets]), sum(buffer.values())
        found = [buckets[int(np.argmax(upto >= q * total))] for q in self.quantiles]
        return [0.0 if b == self._ZERO else 2 * self.growth ** b / (self.growth + 1) for b in found]

    def dump(self, buffer):
        return np.array(sorted(buffer.items()), np.int64).reshape(-1, 2).tobytes()

    def load(self, data):
        return dict(np.frombuffer(data, np.int64).reshape(-1, 2).tolist())


def aggregate(df: DataFrame, keys: Sequence[str], columns: Sequence[str], agg: UserAggregate, result: str, out: str = "result",
              held_groups: int = HELD_GROUPS) -> DataFrame:
    """(keys, out): ``agg`` over ``columns`` of the rows of each group; ``result`` is the type of its result."""
    ship_package(df.sparkSession)
    keys, columns = list(keys), list(columns)
    ddl = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def partial(parts):
        held: dict[tuple, Any] = {}

        def handed():
            frame = pd.DataFrame([dict(zip(keys, k)) for k in held], columns=keys, dtype=object)
            frame["buffer"] = [agg.dump(b) for b in held.values()]
            held.clear()
            return frame

        for frame in parts:
            frame[keys] = frame[keys].astype(object).where(frame[keys].notna(), None)
            for key, at in frame.groupby(keys, dropna=False, sort=False).indices.items() if len(frame) else ():
                key = tuple(None if v is None or v != v else v for v in (key if isinstance(key, tuple) else (key,)))
                held[key] = agg.add(held[key] if key in held else agg.create(), frame.iloc[at][columns])
            if len(held) >= held_groups:
                yield handed()
        if held:
            yield handed()

    def merged(frame):
        buffer = None
        for data in frame["buffer"]:
            other = agg.load(bytes(data))
            buffer = other if buffer is None else agg.merge(buffer, other)
        return buffer

    def by_sender(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.head(1)[keys].assign(buffer=[agg.dump(merged(frame))])

    def to_one(frame: pd.DataFrame) -> pd.DataFrame:
        return frame.head(1)[keys].assign(**{out: [agg.result(merged(frame))]})

    buffers = df.select(*keys, *[c for c in columns if c not in keys]).mapInPandas(partial, f"{ddl}, buffer binary")
    sent = buffers.withColumn("sender", F.spark_partition_id() % FAN)
    few = sent.groupBy(*keys, "sender").applyInPandas(by_sender, f"{ddl}, buffer binary")
    return few.groupBy(*keys).applyInPandas(to_one, f"{ddl}, `{out}` {result}")
