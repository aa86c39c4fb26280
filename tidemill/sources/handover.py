"""S3: the start of a change source, and the hand-over from a snapshot to the change log.

``earliest`` is the log from its beginning.  ``initial`` begins with the table as it is: it is read chunk
by chunk while changes go on, and for each chunk the log's position is noted before (``low``) and
after (``high``) the read.  What was read may or may not hold a change between the two, so those
changes are laid over the rows: the chunk's rows then are those of position ``high``, and the log
goes on from there.  Changes up to ``low`` are in the rows and not told again.  So every change
is told once, as a row of the snapshot or as itself, with no lock and no pause of the log.

Positions are a total order of a key's changes.  Rows are joined by key, marks by chunk; both joins
shuffle unless the planner measures a side as small, and nothing is held for the whole table.
Keys and chunks are not null.  A chunk without rows still has marks; an empty log or table is one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators.dedup import keep_last

__all__ = ["START_MODES", "change_source", "hand_over"]

START_MODES = ("initial", "earliest")


def hand_over(snapshot: DataFrame, log: DataFrame, marks: DataFrame, keys: Sequence[str], position: str = "position",
              chunk: str = "chunk") -> DataFrame:
    """Envelopes (keys, ``position``, op, before, after): op ``r`` for each row of the snapshot, at its
    chunk's ``high`` position, then the later changes as they are.

    ``snapshot``: keys, ``chunk``, ``after`` (the row as read); ``log``: keys, ``chunk``, ``position``, op,
    before, after; ``marks``: ``chunk``, ``low``, ``high``.
    """
    keys = list(keys)
    marked = log.join(marks, chunk)
    at = F.col(position)
    later = marked.where(at > F.col("high")).select(*keys, position, "op", "before", "after")
    during = keep_last(marked.where((at > F.col("low")) & (at <= F.col("high"))), keys, [position])
    over = during.select(*keys, F.col(chunk).alias("__chunk"), F.struct("op", "after").alias("__change"))
    rows = snapshot.select(*keys, chunk, "after").join(over, keys, "full_outer")
    rows = rows.select(*keys, F.coalesce(F.col(chunk), F.col("__chunk")).alias(chunk),
                       F.when(F.col("__change").isNull(), F.col("after")).otherwise(F.col("__change.after")).alias("after"),
                       F.coalesce(F.col("__change.op") == "d", F.lit(False)).alias("__gone"))
    kept = rows.where(~F.col("__gone")).join(marks.select(chunk, F.col("high").alias(position)), chunk)
    none = F.lit(None).cast(log.schema["before"].dataType)
    return kept.select(*keys, position, F.lit("r").alias("op"), none.alias("before"), "after").unionByName(later)


def change_source(start: str, log: DataFrame, keys: Sequence[str], snapshot: DataFrame | None = None, marks: DataFrame | None = None,
                  position: str = "position", chunk: str = "chunk") -> DataFrame:
    """The envelopes of a source with start mode ``initial`` or ``earliest``."""
    if start not in START_MODES:
        raise ValueError(f"start mode {start!r} is none of {START_MODES}")
    if start == "earliest":
        return log.select(*keys, position, "op", "before", "after")
    if snapshot is None or marks is None:
        raise ValueError("start mode 'initial' needs a snapshot and its marks")
    return hand_over(snapshot, log, marks, keys, position, chunk)
