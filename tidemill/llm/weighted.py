"""Distributed weighted quantiles: where the running weight of rows in code order meets a target."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BITS, DIGIT = 60, 15


def weighted_cuts(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(g, cut_code): the rows of group ``g`` with ``code < cut_code`` weigh nearly its target.

    ``rows`` has ``g``, ``code`` (0 to 2**60 - 1) and ``w`` (long, not negative); ``targets`` has
    one row per group: ``g``, ``target`` (double) and ``tolerance`` (double).  Codes are read
    15 bits at a time: each pass sums the weights by digit within the code prefix in which the
    target falls (map-side combined, at most 2**15 sums a group) and picks the next digit, so
    no group is sorted or gathered.  It ends when the prefix left weighs no more than the
    tolerance or holds one row; that rest goes to the nearer side.
    """
    state = targets.select("g", "target", "tolerance", F.lit(0).cast("long").alias("prefix"), F.lit(0.0).alias("below"))
    order = Window.partitionBy("g").orderBy("digit")
    done = None
    for shift in range(BITS - DIGIT, -1, -DIGIT):
        inside = rows.join(state.select("g", "prefix"), rows["g"].eqNullSafe(state["g"])).drop(state["g"])
        inside = inside.where(F.shiftright("code", shift + DIGIT) == F.col("prefix")) if shift + DIGIT < BITS else inside
        digit = F.shiftright("code", shift).bitwiseAND(F.lit(2**DIGIT - 1)).alias("digit")
        sums = inside.groupBy("g", digit).agg(F.sum("w").alias("w"), F.count("*").alias("n")).where("w > 0")
        run = (sums.withColumn("run", F.sum("w").over(order))
               .withColumn("last", F.lead("digit").over(order).isNull()).withColumnRenamed("g", "sum_g"))
        found = run.join(state, F.col("sum_g").eqNullSafe(F.col("g"))).drop("sum_g")
        found = found.where("below + run - w < target and (below + run >= target or last)")
        state = cut(found.select("g", "target", "tolerance", (F.col("prefix") * 2**DIGIT + F.col("digit")).alias("prefix"),
                                 (F.col("below") + F.col("run") - F.col("w")).alias("below"),
                                 F.col("w").alias("unit"), F.col("n").alias("held"), F.lit(shift).alias("shift")), "cuts")
        over = F.lit(shift == 0) | (F.col("unit") <= F.col("tolerance")) | (F.col("held") <= 1)
        ended = state.where(over)
        done = ended if done is None else done.unionByName(ended)
        state = state.where(~over).drop("unit", "held", "shift")
        if state.isEmpty():
            break
    nearer = (F.col("target") - F.col("below") >= F.col("unit") / 2).cast("long")
    return done.withColumn("nearer", nearer).select("g", F.expr("shiftleft(prefix + nearer, shift)").alias("cut_code"))


def code_of(*columns) -> F.Column:
    """60 well-mixed bits of the columns' texts: the first 15 hexadecimal digits of an md5."""
    whole = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("long")
