"""Connected components of an edge table as Spark joins; no edge ever reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, label): each node that has an edge, with the smallest node it can reach.

    ``edges`` has long columns ``a`` and ``b``.  Every round hooks each live node to its
    smallest neighbour, follows the hooks twice and contracts the edges, so the live edges
    shrink geometrically; rounds are cut at the shared checkpoint folder.  Hooks are a
    map-side combined minimum, so a hot node is not gathered in one task.
    """
    live = cut(_ordered(edges), "edges")
    labels = None
    while not live.isEmpty():
        ends = live.select(F.col("a").alias("u"), F.col("b").alias("v")).union(live.select("b", "a"))
        hook = ends.groupBy("u").agg(F.min("v").alias("p")).select("u", F.least("u", "p").alias("p"))
        hook = cut(_follow(_follow(hook)), "hooks")
        named = hook.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        live = live.join(hook.select(F.col("u").alias("a"), F.col("p").alias("pa")), "a").join(named, "b")
        live = cut(_ordered(live.select(F.col("pa").alias("a"), F.col("pb").alias("b"))), "edges")
        if labels is None:
            labels = hook.select(F.col("u").alias("node"), F.col("p").alias("label"))
        else:
            step = hook.select(F.col("u").alias("label"), "p")
            labels = labels.join(step, "label", "left").select("node", F.coalesce("p", "label").alias("label"))
    if labels is None:
        return live.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels


def _ordered(edges: DataFrame) -> DataFrame:
    return (edges.where("a <> b")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def _follow(hook: DataFrame) -> DataFrame:
    return hook.alias("x").join(hook.alias("y"), F.col("x.p") == F.col("y.u")).select("x.u", "y.p")
