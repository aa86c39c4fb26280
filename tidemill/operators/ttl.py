"""W10 in batch: state that expires when a key is silent for too long.

A state whose every record writes it (D1, D3, D7 to D10) is gone for a record that comes ``ttl_ms`` or
more after the one before it; from there on the key is as good as new.  So a key's records fall
into lives: a life begins with the first record and after each such gap.  With the life as one more
key the operators without expiry give what the state machines with expiry give.

The clock is a column of the records, the time at which the machine would see them, so the answer
doesn't depend on when it is asked for.  A clock that runs back between two records is no gap;
records without a clock neither expire a state nor are the end of a gap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .dedup import daily_unique, monotone_latest, retract_duplicates
from .keyed import keyed_lag, keyed_prefix_max

__all__ = ["LIFE", "with_lives", "retract_with_ttl", "monotone_with_ttl", "daily_unique_with_ttl"]

LIFE = "life"


def with_lives(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], number: str, clock_ms: str, ttl_ms: int,
               hot_rows: int | None = None) -> DataFrame:
    """``df`` with ``life``: the ``number`` of the record that began the life of its key's state.

    ``number`` is a column of whole numbers that grow along ``order`` within a key.  Two passes over
    each key, both split where a key holds many rows.
    """
    lagged = keyed_lag(df, keys, order, [clock_ms], hot_rows, suffix="__before", arrival=number)
    silent = F.coalesce(F.col(clock_ms) - F.col(f"{clock_ms}__before") >= ttl_ms, F.lit(False))
    begun = lagged.withColumn("__begun", F.when(silent, F.col(number).cast("long"))).drop(f"{clock_ms}__before")
    upto = keyed_prefix_max(begun, keys, order, "__begun", hot_rows, out="__earlier", arrival=number)
    return upto.withColumn(LIFE, F.coalesce(F.greatest("__begun", "__earlier"), F.lit(-(1 << 62)))).drop("__begun", "__earlier")


def retract_with_ttl(df: DataFrame, ids: Sequence[str], number: str, amounts: Sequence[str], clock_ms: str, ttl_ms: int,
                     hot_rows: int | None = None) -> DataFrame:
    """A record is taken back by the next of its id, unless the state expired before that came."""
    lives = with_lives(df, ids, [number], number, clock_ms, ttl_ms, hot_rows)
    return retract_duplicates(lives, [*ids, LIFE], [number], amounts).drop(LIFE)


def monotone_with_ttl(df: DataFrame, keys: Sequence[str], number: str, ts: str, clock_ms: str, ttl_ms: int,
                      hot_rows: int | None = None) -> DataFrame:
    """D3: a record passes if its ``ts`` exceeds all earlier ones of its key that the state still knows."""
    lives = with_lives(df, keys, [number], number, clock_ms, ttl_ms, hot_rows)
    return monotone_latest(lives, [*keys, LIFE], [number], ts, hot_rows).drop(LIFE)


def daily_unique_with_ttl(df: DataFrame, keys: Sequence[str], number: str, ts_ms: str, clock_ms: str, ttl_ms: int, out: str = "uv_ct",
                          hot_rows: int | None = None) -> DataFrame:
    """The daily gate, which also fires after the state of a silent key expired."""
    lives = with_lives(df, keys, [number], number, clock_ms, ttl_ms, hot_rows)
    return daily_unique(lives, [*keys, LIFE], [number], ts_ms, out, hot_rows=hot_rows).drop(LIFE)
