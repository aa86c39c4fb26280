"""A keyed-state operator with side outputs, split once into several topics.

A processor returns a frame for each tag; the operator emits them as one stream of tagged rows over the
columns of all outputs, and one query writes that stream to a folder a tag, exactly once.  So the
input is read and the state kept once, however many outputs there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import state_dir
from .jobs import start
from .stateful import KeyedProcessor, NewVisitorRepair, apply_processor

__all__ = ["SideOutputs", "LogSplit", "side_outputs", "to_topics", "log_topics"]


class SideOutputs(KeyedProcessor):
    """Base: ``outputs`` (DDL of the columns that outputs may have) and ``split(df, code, state) ->
    ({tag: frame}, new)`` (see ``KeyedProcessor``); columns that a frame lacks are null in its rows."""

    outputs = ""

    def split(self, df: pd.DataFrame, code: np.ndarray, state: np.ndarray) -> tuple[dict[str, pd.DataFrame], np.ndarray | None]:
        raise TypeError("a processor says what goes to which output")

    def process(self, df, code, state):
        frames, new = self.split(df, code, state)
        names = [c.split()[0] for c in self.outputs.split(", ")]
        tagged = [f.reindex(columns=names).assign(topic=tag) for tag, f in frames.items() if len(f)]
        return (pd.concat(tagged, ignore_index=True) if tagged else pd.DataFrame(columns=[*names, "topic"], dtype=object)), new

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        for out in super().handleInputRows(key, rows, timerValues):
            yield out.astype(object).where(out.notna(), None)


class LogSplit(SideOutputs):
    """P2 and D6 in one: the splitter of the log, with the new-visitor flag repaired by the device's first
    record.  Outputs: ``err``, ``start``, one row for each element to ``display`` and ``action``, and
    ``page`` for what isn't a start."""

    outputs = "arrival long, mid string, is_new string, ts long, body string"
    kind = NewVisitorRepair.kind

    def __init__(self, ttl_ms: int | None = 10_000):
        self.ttl_ms = ttl_ms
        self._repair = NewVisitorRepair(ttl_ms=ttl_ms, out="fixed")

    def split(self, df, code, state):
        df, new = self._repair.process(df, code, state)
        df = df.assign(is_new=df["fixed"])
        is_start = df["start"].notna()
        rest = df[~is_start]
        own = ["arrival", "mid", "is_new"]

        def body(rows, column, *more):
            return rows[rows[column].notna()][[*own, *more, column]].rename(columns={column: "body"})

        def each(column, *more):
            # a bucket of starts only has no rows here, and the mask of no rows would be no mask
            some = rest[rest[column].map(lambda v: v is not None and np.size(v) > 0).astype(bool)]
            return body(some.explode(column), column, *more)

        page = rest[[*own, "ts", "page"]].rename(columns={"page": "body"})
        return {"err": body(df, "err"), "start": body(df, "start", "ts"), "display": each("displays", "ts"),
                "action": each("actions"), "page": page}, new


def side_outputs(stream: DataFrame, keys: list[str], processor: SideOutputs) -> DataFrame:
    """The tagged rows of all outputs: the columns of ``processor.outputs`` and ``topic``."""
    return apply_processor(stream, keys, processor, processor.outputs + ", topic string")


def to_topics(spark: SparkSession, tagged: DataFrame, name: str, trigger: dict | None = None, ends: bool = False) -> tuple[StreamingQuery, str]:
    """Write tagged rows to a folder for each topic; (query, path), a topic being ``path/topic=<tag>``."""
    path = state_dir(spark, name) + "-topics"
    return start(spark, tagged, name, path=path, trigger=trigger, ends=ends, partition_by=["topic"]), path


def log_topics(log: DataFrame, ttl_ms: int | None = 10_000) -> DataFrame:
    """The parsed log (``arrival`` and the fields of P1) as tagged rows of five topics; payloads are JSON."""
    json = lambda c: F.when(F.col(c).isNotNull(), F.to_json(c)).alias(c)
    rows = log.select("arrival", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"), "ts", json("err"), json("start"),
                      json("page"), *[F.transform(c, lambda x: F.to_json(x)).alias(c) for c in ("displays", "actions")])
    return side_outputs(rows, ["mid"], LogSplit(ttl_ms))
