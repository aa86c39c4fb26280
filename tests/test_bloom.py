"""Bloom filters: nothing new is lost, the rate of false positives, exact results after the check."""

import os
import time
import uuid

import pytest
from pyspark.sql import functions as F

from tidemill.operators import bloom as B
from tidemill.streaming import jobs as S


def test_rate_of_false_positives_and_no_false_negative(spark):
    n, fpp = 20_000, 0.02
    seen = spark.range(n).select(F.concat(F.lit("key"), "id").alias("k"), (F.col("id") % 7).alias("g"))
    other = spark.range(n, 4 * n).select(F.concat(F.lit("key"), "id").alias("k"), (F.col("id") % 7).alias("g"))
    filter_ = B.bloom_build(seen, ["k", "g"], n, fpp)
    bits, k = B.filter_size(n, fpp)
    assert filter_.count() <= -(-bits // B.BLOCK_BITS) and k == 6
    probe = lambda df: B.bloom_probe(df, ["k", "g"], filter_, n, fpp).agg(F.avg(F.col("maybe_seen").cast("int"))).first()[0]
    assert probe(seen) == 1.0
    assert 0 < probe(other) < 1.5 * fpp


def test_merged_filters_hold_the_keys_of_all(spark):
    parts = [spark.range(k * 500, (k + 1) * 500).select("id") for k in range(3)]
    filters = [B.bloom_build(p, ["id"], 1500, 0.01) for p in parts]
    merged = B.bloom_merge(*filters)
    whole = B.bloom_build(spark.range(1500), ["id"], 1500, 0.01)
    rows = lambda df: sorted((r.block, bytes(r.bitmap)) for r in df.collect())
    assert rows(merged) == rows(whole)


ROWS = [(None, None, 1), (None, None, 2), (1, None, 3), (None, 1, 4), (1, 1, 5), (1, 1, 6), (2, 3, 7), (3, 2, 8), (3, 2, 9)]


@pytest.mark.parametrize("n", [1, 1000])
def test_dedup_is_exact_with_any_expected_number(spark, n):
    """A filter for one key (of one block) is full after the first thousand keys: all rows are doubtful."""
    new = spark.createDataFrame(ROWS, "a long, b long, arrival long").unionByName(
        spark.range(100, 1100).select(F.col("id").alias("a"), F.col("id").alias("b"), F.col("id").alias("arrival")))
    seen = spark.createDataFrame([(3, 2), (None, None)], "a long, b long").unionByName(
        spark.range(600, 9000).select(F.col("id").alias("a"), F.col("id").alias("b")))
    got = sorted(r.arrival for r in B.bloom_dedup(new, seen, ["a", "b"], ["arrival"], n).collect())
    assert got == [3, 4, 5, 7, *range(100, 600)]
    assert B.bloom_dedup(new, seen.limit(0), ["a", "b"], ["arrival"], n).count() == 1006
    assert B.bloom_dedup(new.limit(0), seen, ["a", "b"], ["arrival"], n).count() == 0


@pytest.mark.parametrize("n", [1, 5000])
def test_stream_passes_every_first_row_or_doubts_it(spark, tmpdir_path, n):
    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 900).alias("key"), F.col("id").alias("arrival"))
    path = os.path.join(tmpdir_path, "rows")
    for k in range(4):
        rows.where(f"arrival >= {k * 1000} and arrival < {(k + 1) * 1000}").coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)
    gated = B.bloom_stream(stream, ["key"], "arrival", n, 0.01, buckets=4)
    query, out = S.to_topic(spark, gated, f"test/{uuid.uuid4().hex[:8]}", ends=True)
    assert query.awaitTermination(120)
    topic = spark.read.schema(gated.schema).parquet(out)
    assert topic.count() == 4000
    firsts = {r.arrival for r in rows.groupBy("key").agg(F.min("arrival").alias("arrival")).collect()}
    sure = {r.arrival for r in topic.where("not doubtful").collect()}
    assert sure <= firsts and (n == 1 or len(sure) > 0.9 * len(firsts))
    assert {r.arrival for r in B.settle_doubtful(topic, ["key"], ["arrival"]).collect()} == firsts
