"""Lookups in a running stream: a dimension that changes between micro-batches, with and without expiry."""

import os
import time
import uuid

from pyspark.sql import functions as F

from tidemill.streaming.lookups import DimensionCopy, lookup_stream


def test_later_batches_see_a_changed_row_after_the_period(spark, tmpdir_path):
    facts, dims = os.path.join(tmpdir_path, "facts"), os.path.join(tmpdir_path, "dims")
    clock, versions = [1000.0], [0]

    def dim(*rows):
        versions[0] += 1
        spark.createDataFrame(list(rows), "code string, name string").coalesce(1).write.parquet(f"{dims}/{versions[0]}")

    copy = DimensionCopy(lambda: spark.read.parquet(f"{dims}/{versions[0]}"), period_s=600, clock=lambda: clock[0])
    name, out = f"test/{uuid.uuid4().hex[:8]}", os.path.join(tmpdir_path, "out")

    def put(*rows):
        time.sleep(0.05)
        spark.createDataFrame(list(rows), "id long, code string").coalesce(1).write.mode("append").parquet(facts)
        stream = spark.readStream.schema("id long, code string").parquet(facts)
        query, _ = lookup_stream(stream, copy, "code", "code", {"name": "name"}, out, name)
        assert query.awaitTermination(120)
        return {r.id: r.name for r in spark.read.schema("id long, code string, name string").parquet(f"{out}/batch=*").collect()}

    dim(("a", "one"), ("b", "two"))
    assert put((1, "a"), (2, "z"), (3, None)) == {1: "one", 2: "N/A", 3: "N/A"}
    dim(("a", "changed"), ("z", "new"))
    clock[0] += 599
    assert put((4, "a"), (5, "z"), (6, "b"))[4] == "one"  # the copy still holds
    clock[0] += 1
    got = put((7, "a"), (8, "z"), (9, "b"))
    assert got == {1: "one", 2: "N/A", 3: "N/A", 4: "one", 5: "N/A", 6: "two", 7: "changed", 8: "new", 9: "N/A"}
    assert copy.reads == 2
    copy.close()


def test_an_empty_dimension(spark, tmpdir_path):
    facts = os.path.join(tmpdir_path, "facts")
    spark.range(3).select("id", F.lit("a").alias("code")).coalesce(1).write.parquet(facts)
    copy = DimensionCopy(lambda: spark.createDataFrame([], "code string, name string"))
    stream = spark.readStream.schema("id long, code string").parquet(facts)
    query, out = lookup_stream(stream, copy, "code", "code", {"name": "name"}, os.path.join(tmpdir_path, "out"), f"test/{uuid.uuid4().hex[:8]}")
    assert query.awaitTermination(120)
    assert {r.name for r in spark.read.parquet(f"{out}/batch=*").collect()} == {"N/A"}
