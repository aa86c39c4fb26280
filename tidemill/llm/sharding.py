"""Sharding by k-d tree partitioning (operator 8), in DataFrame functions only.

Rows are points in the space of their metadata (language, source, size).  A node of the tree
that is to become ``k`` shards splits along its widest dimension where ``k // 2`` of ``k`` shares
of its bytes lie on one side - for ``k = 2`` the weighted median - until every leaf holds one
share, the target bytes.  The splits of one level are found together, by distributed weighted
quantiles; a level's nodes are at most as many as there are shards, which bounds what is
broadcast.

Copies of one text form a group: it lies at the least language and source of its rows, and
within a coordinate rows are ordered by group, then by row.  A split therefore cuts at most
one group, and only if the group is larger than the tolerance: groups stay whole unless that
would make shards uneven.

Edge cases: null text has no bytes but the row's 16; null language or source is a coordinate
of its own; repeated rows are placed each for itself; shards without rows stay empty; other
columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .weighted import DIGIT, weighted_cuts

ROW_BYTES, TOLERANCE, SLOT_ROWS = 16, 0.002, 5000
SPAN = 2**DIGIT - 1
DIMENSIONS = ("at_lang", "at_source", "at_size")


def _points(docs: DataFrame) -> DataFrame:
    """doc_id, w (bytes), text_crc32, two hashes for order, and the coordinates, 0 to SPAN."""
    text = F.coalesce(F.col("text"), F.lit(""))
    low = lambda *c: F.xxhash64(*c).bitwiseAND(F.lit(2**30 - 1))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("w"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("same"), "lang", "source")
    rows = cut(rows, "shard-rows")
    groups = rows.groupBy("same").agg(F.min("lang").alias("lang"), F.min("source").alias("source"))
    spot = lambda c: F.coalesce(F.xxhash64(c).bitwiseAND(F.lit(SPAN)), F.lit(0))
    size = F.least(F.lit(SPAN), F.floor(F.log2(F.col("w")) * (SPAN / 40))).cast("long")
    rows = rows.drop("lang", "source").join(cut(groups, "shard-groups"), "same")
    return rows.select("doc_id", "w", "text_crc32", low("same").alias("group_bits"),
                       F.xxhash64("doc_id", "same").bitwiseAND(F.lit(SPAN)).alias("row_bits"),
                       spot("lang").alias("at_lang"), spot("source").alias("at_source"), size.alias("at_size"))


def kd_shards(docs: DataFrame, shards: int) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): leaves of near equal bytes, rows numbered in each."""
    rows = _points(docs).withColumn("lo", F.lit(0)).withColumn("k", F.lit(shards))
    rows = cut(rows, "shard-points")
    total = rows.agg(F.sum("w")).first()[0] or 0
    tolerance = TOLERANCE * total / shards
    for _ in range(math.ceil(math.log2(shards)) if total else 0):
        spans = [(F.max(d) - F.min(d)).alias(f"width_{d}") for d in DIMENSIONS]
        nodes = rows.where("k > 1").groupBy("lo", "k").agg(F.sum("w").alias("bytes"), *spans)
        widest = F.greatest(*[F.col(f"width_{d}") for d in DIMENSIONS])
        dim = F.coalesce(*[F.when(F.col(f"width_{d}") == widest, F.lit(i)) for i, d in enumerate(DIMENSIONS)])
        nodes = cut(nodes.select("lo", dim.alias("dim"), (F.floor(F.col("k") / 2) / F.col("k") * F.col("bytes")).alias("target")),
                    "shard-nodes")
        at = F.element_at(F.array(*[F.col(d) for d in DIMENSIONS]), F.col("dim") + 1)
        coded = (rows.join(F.broadcast(nodes), "lo", "left")
                 .withColumn("code", (at * 2**30 + F.col("group_bits")) * 2**DIGIT + F.col("row_bits")))
        coded = cut(coded.drop("dim", "target"), "shard-codes")
        cuts = weighted_cuts(coded.where("code is not null").select(F.col("lo").alias("g"), "code", "w"),
                             nodes.select(F.col("lo").alias("g"), "target", F.lit(tolerance).alias("tolerance")))
        out = coded.join(F.broadcast(cuts.withColumnRenamed("g", "lo")), "lo", "left")
        left = (F.col("code") < F.col("cut_code")).alias("left")
        half = F.floor(F.col("k") / 2).cast("int")
        moved = out.select(*rows.columns, left)
        rows = moved.select(*[c for c in rows.columns if c not in ("lo", "k")],
                            F.when(F.col("left") | F.col("left").isNull(), F.col("lo")).otherwise(F.col("lo") + half).alias("lo"),
                            F.when(F.col("left"), half).when(F.col("left").isNull(), F.col("k")).otherwise(F.col("k") - half).alias("k"))
        rows = cut(rows, "shard-level")
    return _slots(rows.select("doc_id", F.col("w").alias("size"), "text_crc32", F.col("lo").cast("int").alias("shard")))


def _slots(rows: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0 without gaps: within parts of a shard first, then
    shifted by the sizes of the parts before, so that no shard is sorted in one task."""
    parts = max(1, math.ceil(rows.count() / SLOT_ROWS))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(parts)).cast("int"))
    sizes = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    order = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("place", F.row_number().over(order) - 1).join(shift, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", "shard", (F.col("shift") + F.col("place")).alias("slot")))
