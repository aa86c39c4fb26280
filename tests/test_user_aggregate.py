"""Aggregates with buffers of their own against all rows of each group."""

import math

import pytest
from pyspark.sql import functions as F

from tidemill.operators.user_aggregate import QuantileSketch, UserAggregate, aggregate


def _longest():
    """The longest word of a group, the first in the alphabet of equal ones (a class that tasks get by value)."""
    class Longest(UserAggregate):
        def create(self):
            return ""

        def add(self, buffer, rows):
            return min([buffer, *rows["word"].dropna()], key=lambda w: (-len(w), w))

        def merge(self, one, other):
            return min(one, other, key=lambda w: (-len(w), w))

    return Longest()


def _rows(spark):
    hot = spark.range(6000).select(F.lit("hot").alias("k"), (F.col("id") % 4).alias("g"), F.exp(F.col("id") % 700 / 100).alias("x"))
    rest = spark.range(9000).select(F.when(F.col("id") % 5 > 0, F.concat(F.lit("k"), (F.col("id") % 5).cast("string"))).alias("k"),
                                    F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"),
                                    F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 13 == 0, -1.0)
                                    .otherwise(F.col("id") % 997 / 10).alias("x"))
    return hot.unionByName(rest).repartition(7)


@pytest.mark.parametrize("held", [1, 3, 1 << 14])
def test_quantiles_against_sorted_values(spark, held):
    quantiles = [0.0, 0.25, 0.5, 0.99, 1.0]
    df = _rows(spark)
    got = {(r.k, r.g): r.q for r in aggregate(df, ["k", "g"], ["x"], QuantileSketch("x", quantiles), "array<double>", "q", held).collect()}
    groups = {}
    for r in df.collect():
        groups.setdefault((r.k, r.g), []).append(r.x)
    assert got.keys() == groups.keys()
    for key, values in groups.items():
        values = sorted(max(0.0, v) for v in values if v is not None)
        for q, found in zip(quantiles, got[key]):
            true = values[max(0, math.ceil(q * len(values)) - 1)]
            assert abs(found - true) <= 0.0101 * true, (key, q, found, true)


def test_own_aggregate_and_edges(spark):
    words = spark.createDataFrame([(1, "a"), (1, "ccc"), (1, "bbb"), (2, None), (None, "x"), (1, "ccc")], "k long, word string")
    got = {r.k: r.result for r in aggregate(words.repartition(3), ["k"], ["word"], _longest(), "string").collect()}
    assert got == {1: "bbb", 2: "", None: "x"}
    assert aggregate(words.limit(0), ["k"], ["word"], _longest(), "string").count() == 0
    nothing = aggregate(words.select("k", F.lit(None).cast("double").alias("x")), ["k"], ["x"], QuantileSketch("x", [0.5]), "array<double>")
    assert {tuple(r.result) for r in nothing.collect()} == {(None,)}
