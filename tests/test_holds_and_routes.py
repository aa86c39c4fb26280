"""Holds that end by a timer, routing by a config that changes, and streams in many small batches."""

import os
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from table_paths import SF_SMALL
from test_oracle import TABLES, _canon
from tidemill import sinks as K
from tidemill.plans import queries as Q
from tidemill.streaming import jobs as S
from tidemill.streaming.hold import close_holds, hold_last

KEYED = ["stream_page_view_window", "stream_home_detail_uv", "stream_login_return_users", "stream_cart_unique_users", "stream_retract",
         "stream_first_seen_flag", "stream_monotone_latest", "stream_daily_unique", "stream_new_visitor_repair", "stream_login_flags",
         "stream_keep_last_detail", "stream_hold_last", "stream_dim_config_route", "stream_bloom_dedup",
         "stream_log_topics"]


@pytest.mark.parametrize("name", KEYED)
def test_streams_in_many_small_batches(spark, name):
    """Topics of a few hundred rows a step: state is carried over several micro-batches."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    spark.conf.set("spark.tidemill.topicRows", "2500" if name in ("stream_retract", "stream_keep_last_detail", "stream_hold_last") else "400")
    try:
        got = Q.QUERIES[name](spark, SF_SMALL)
        want = con.execute(Q.ORACLE[name])
        names = [c[0] for c in want.description]
        assert sorted(got.columns) == sorted(names)
        assert _canon(got.columns, [tuple(r) for r in got.collect()]) == _canon(names, want.fetchall())
    finally:
        spark.conf.unset("spark.tidemill.topicRows")


def _brute_holds(rows, hold_ms):
    """What a per-record machine emits: (id, version) of the greatest record of each hold."""
    out, held = [], {}
    for key, version, at in sorted(rows, key=lambda r: r[2]):
        if key in held and at >= held[key][1]:
            out.append((key, held.pop(key)[0]))
        best, end = held.get(key, (version, at + hold_ms))
        held[key] = (max(best, version), end)
    return sorted(out + [(k, v) for k, (v, _) in held.items()], key=repr)


def test_holds_against_a_machine_of_records(spark, tmpdir_path):
    """One id has a third of all rows; holds end between batches and inside them; null is an id."""
    import random

    rnd = random.Random(2)
    rows = [("hot" if rnd.random() < 0.34 else rnd.choice([None, "a", "b", "c", "d"]), rnd.randrange(10**6), at * 37 + rnd.randrange(37))
            for at in range(1500)]
    df = close_holds(spark.createDataFrame(rows, "id string, version long, at long"), "at", "closing", 60_000)
    path = os.path.join(tmpdir_path, "holds")
    import time
    for k in range(4):
        part = df.where((F.col("at") >= k * 15_000) & ((F.col("at") < (k + 1) * 15_000) | F.lit(k == 3)))
        part.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    held = hold_last(stream, ["id"], ["version"], "at", hold_ms=5000, buckets=3, marker="closing")
    query, out = S.to_topic(spark, held, f"test/{uuid.uuid4().hex[:8]}")
    assert query.awaitTermination(180)
    got = sorted(((r.id, r.version) for r in spark.read.schema(held.schema).parquet(out).collect()), key=repr)
    assert got == _brute_holds(rows, 5000)


def test_an_open_hold_is_not_emitted(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "open")
    df = spark.createDataFrame([("a", 1, 1000), ("a", 2, 2000), ("b", 7, 9000)], "id string, version long, at long")
    df.coalesce(1).write.parquet(path)
    held = hold_last(spark.readStream.schema(df.schema).parquet(path), ["id"], ["version"], "at")
    query, out = S.to_topic(spark, held, f"test/{uuid.uuid4().hex[:8]}")
    assert query.awaitTermination(120)
    assert [(r.id, r.version) for r in spark.read.schema(held.schema).parquet(out).collect()] == [("a", 2)]


CHANGES = "arrival long, op string, source_table string, sink_table string, row_key string"


def test_config_versions(spark):
    log = spark.createDataFrame([
        (1, "r", "t", "one", "id"), (5, "u", "t", "two", "id"), (9, "d", "t", None, None), (12, "c", "t", "three", "id"),
        (5, "d", "s", None, None), (5, "c", "s", "again", "id"), (3, "c", "s", "first", "id"), (2, "c", None, "x", "id")], CHANGES)
    got = sorted((r.source_table, r.sink_table, r.valid_from, r.valid_to) for r in K.config_versions(log).collect())
    assert got == [("s", "again", 5, None), ("s", "first", 3, 5), ("t", "one", 1, 5), ("t", "three", 12, None), ("t", "two", 5, 9)]
    assert K.config_versions(log.limit(0)).count() == 0


def test_later_batches_see_a_config_change(spark, tmpdir_path):
    """The config changes while the stream stands still between two runs; earlier rows stay where they went."""
    rows, config = os.path.join(tmpdir_path, "rows"), os.path.join(tmpdir_path, "config")
    schema = "arrival long, op string, _table string, data map<string,string>"

    def put(path, schema, *values):
        spark.createDataFrame(list(values), schema).coalesce(1).write.mode("append").parquet(path)

    name = f"test/{uuid.uuid4().hex[:8]}"

    def run():
        stream = spark.readStream.schema(schema).parquet(rows)
        query, out = K.dim_config_route_stream(stream, lambda: spark.read.schema(CHANGES).parquet(config),
                                               os.path.join(tmpdir_path, "out"), name)
        assert query.awaitTermination(120)
        return {(r.arrival, r.sink_table) for r in spark.read.option("basePath", out).parquet(f"{out}/batch=*").collect()}

    put(config, CHANGES, (0, "r", "t", "one", "id"))
    put(rows, schema, (1, "c", "t", {"id": "1"}), (2, "d", "t", {"id": "1"}), (2, "c", "unknown", {"id": "1"}))
    assert run() == {(1, "one")}
    put(config, CHANGES, (3, "u", "t", "two", "id"), (6, "d", "t", None, None))
    put(rows, schema, (2, "u", "t", {"id": "2"}), (4, "c", "t", {"id": None}), (7, "c", "t", {"id": "3"}))
    assert run() == {(1, "one"), (2, "one"), (4, "two")}


class _Held:
    """State and timers of one bucket."""

    def __init__(self):
        self.value, self.at = None, set()

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def listTimers(self):  # noqa: N802
        return iter(self.at)

    def registerTimer(self, at):  # noqa: N802
        self.at.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.at.discard(at)

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return 100_000


def test_holds_of_a_micro_batch_in_pieces_out_of_order():
    """A bucket's rows come in pieces; the later records of an id may lie in the first."""
    import random

    import pandas as pd

    from tidemill.streaming.hold import HoldLast

    rnd = random.Random(5)
    rows = [(f"k{k}", place, 500 * k + 2000 * place) for k in range(40) for place in range(rnd.randrange(1, 8))]
    rnd.shuffle(rows)
    df = pd.DataFrame([(k, v, k, at, False) for k, v, at in rows], columns=["id", "version", "hold_id", "hold_at_ms", "hold_closing"])
    processor, handle = HoldLast(["id", "version"], ["version"], 5000), _Held()
    processor.init(handle)
    out = pd.concat(processor.handleInputRows((0,), iter([df[k:k + 15] for k in range(0, len(df), 15)]), handle))
    assert sorted(zip(out["id"], out["version"]), key=repr) == _brute_holds(rows, 5000)
    assert handle.value is None and not handle.at
