"""Mixing sources to target weights by capped water-filling (operator 1).

Sources share a budget of words by weight.  A source whose share is above its size times
``max_epochs`` is clamped there and its excess is shared again by weight among the others,
round by round, until none is above.  Each document is then taken ``floor(target / size of
its source)`` times, and the fraction that remains is met by a seeded sample of whole
documents: in the order of a hash of the row, documents get one more repetition until their
sizes meet the fraction of the source.  The cut in that order comes from distributed weighted
quantiles, so the words taken miss the target by at most one document, and reruns agree.

Edge cases: a null source is a source like others; null and empty texts have size 0 and are
taken as often as their neighbours in hash order, and ``least_epochs`` whole times where a
source has no words at all; rows repeated in the input each count; a
source without weight (null, zero or negative) gets no words; an empty table gives an empty
result; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, packed, word_count
from .weighted import code_of, weighted_cuts

SEED = 17


def ranked_weights(docs: DataFrame, weights: list[float]) -> DataFrame:
    """(source, weight): ``weights`` repeated over the sources by code point, null last.

    The order is over the table of distinct sources, one short row each.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    return docs.select("source").distinct().select(
        "source", F.get(F.array(*[F.lit(float(w)) for w in weights]), place).alias("weight"))


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """``sources`` (with ``weight`` and ``source_size``) and the ``target`` of each.

    One round clamps all sources above their cap; two sums per round come to the driver.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = 0.0, F.lit(False)
    count = -1
    while True:
        free = ~clamped & (F.col("weight") > 0)
        r = sources.agg(F.sum(F.when(clamped, cap)).alias("held"), F.sum(F.when(free, F.col("weight"))).alias("weight"),
                        F.sum(clamped.cast("long")).alias("n")).first()
        if r["n"] == count or not r["weight"]:
            break
        count = r["n"]
        level = max(0.0, budget - (r["held"] or 0.0)) / r["weight"]
        clamped = (F.col("weight") > 0) & (cap <= F.lit(level) * F.col("weight"))
    target = F.when(F.col("weight") > 0, F.least(cap, F.lit(level) * F.col("weight"))).otherwise(F.lit(0.0))
    return sources.withColumn("target", target)


def repetitions(docs: DataFrame, weights: DataFrame, budget_ratio: float = 1.5, max_epochs: float = 2.0,
                least_epochs: float = 0.0, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(the rows as structs with ``mix_size``, ``mix_code`` and ``mix_source``; plan by source).

    The plan has per source ``source_size``, ``target``, ``whole`` repetitions and the
    ``cut_code`` under which a row gets one more.  ``least_epochs`` gives every source that many
    epochs first and fills only the rest of the budget by weight.
    """
    sized = packed(docs, word_count(F.col("text")).alias("mix_size"), F.col("source").alias("mix_source"),
                   code_of(F.lit(seed), F.col("doc_id"), F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))).alias("mix_code"))
    slim = cut(sized.select("mix_source", "mix_size", "mix_code"), "mix-sizes")
    sums = slim.groupBy("mix_source").agg(F.sum("mix_size").alias("source_size"))
    given = weights.select(F.col("source").alias("w_source"), "weight")
    sources = cut(sums.join(given, F.col("mix_source").eqNullSafe(F.col("w_source")), "left").drop("w_source"), "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    filled = water_fill(sources, (budget_ratio - least_epochs) * total, max_epochs - least_epochs)
    filled = filled.withColumn("target", F.col("target") + F.col("source_size") * F.lit(float(least_epochs)))
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(float(least_epochs)))
    filled = filled.withColumn("whole", F.floor(epochs + 1e-12))
    filled = cut(filled.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    cuts = weighted_cuts(slim.select(F.col("mix_source").alias("g"), F.col("mix_size").alias("w"), F.col("mix_code").alias("code")),
                         filled.where("rest > 0").select(F.col("mix_source").alias("g"), F.col("rest").alias("target"),
                                                         F.lit(0.0).alias("tolerance")))
    plan = filled.join(cuts, F.col("mix_source").eqNullSafe(F.col("g")), "left").select(
        F.col("mix_source").alias("p_source"), "source_size", "target", "whole", F.coalesce("cut_code", F.lit(0)).alias("cut_code"))
    return sized, cut(plan, "mix-plan")


def mix(docs: DataFrame, weights: DataFrame, **options) -> DataFrame:
    """``row`` (a struct of all columns), ``size``, ``source_size``, ``target`` and ``times`` (repetitions)."""
    sized, plan = repetitions(docs, weights, **options)
    times = F.col("whole") + (F.col("mix_code") < F.col("cut_code")).cast("long")
    return sized.join(plan, F.col("mix_source").eqNullSafe(F.col("p_source"))).select(
        "row", F.col("mix_size").alias("size"), "source_size", "target", times.alias("times"))


def mixed_documents(docs: DataFrame, weights: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it."""
    out = mix(docs, weights, **options).where("times > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("again")).select("row.*")
