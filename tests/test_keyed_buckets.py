"""Keyed processors over buckets: all keys of a bucket at once must give what a machine a key and a
record gives, however rows are cut into micro-batches, with a few state calls a micro-batch."""

import json

import numpy as np
import pandas as pd
import pytest

from tidemill.streaming import stateful as S

DAY = S.DAY_MS


class _Value:
    def __init__(self):
        self.value, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


class _Handle:
    def __init__(self):
        self.state = _Value()

    def getValueState(self, name, schema, ttl_ms=None):  # noqa: N802
        return self.state


class _Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return self.now


def _rows(n=400, keys=30):
    rng = np.random.default_rng(7)
    ts = np.sort(rng.integers(0, 25 * DAY, n)) + rng.integers(-DAY, DAY, n) + DAY
    key = [None if k == 0 else f"k{k}" for k in rng.integers(0, keys, n)]
    return pd.DataFrame({"arrival": np.arange(n), "key": key, "ts": ts, "is_new": rng.choice(["0", "1"], n),
                         "record": [f"r{i}" for i in range(n)]})


def _run(processor, rows, cuts, clock=lambda k: k):
    handle = _Handle()
    processor.init(handle)
    rows = rows.assign(**{S._KEY: rows["key"].map(lambda k: json.dumps({"key": k})), S._BUCKET: 0})
    out = []
    for k, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(rows)])):
        part = rows.iloc[low:high].sample(frac=1, random_state=3)  # a shuffle keeps no order
        half = len(part) // 2
        out += list(processor.handleInputRows((0,), iter([part[:half], part[half:]]), _Clock(clock(k))))
    assert handle.state.calls <= 2 * (len(cuts) + 1)
    return pd.concat(out)


def _machine(rows, step):
    """One state a key, one record at a time; ``step(row, state) -> (outputs, state)``."""
    held, out = {}, []
    for row in rows.to_dict("records"):
        made, held[row["key"]] = step(row, held.get(row["key"]))
        out += made
    return sorted(out)


def _gate(row, day):
    now = row["ts"] // DAY
    return [(row["arrival"], int(day is None or day != now))], now


def _login(row, day):
    now = row["ts"] // DAY
    uu = day is None or day != now
    back = day is not None and day != now and int((row["ts"] - day * DAY) / DAY) >= 8
    return ([(row["arrival"], int(uu), int(back))] if uu or back else []), now


def _repair(row, first):
    first = row["ts"] // DAY - (row["is_new"] != "1") if first is None else first
    return [(row["arrival"], "0" if row["is_new"] == "1" and row["ts"] // DAY != first else row["is_new"])], first


def _retract(row, last):
    return ([(last, 1)] if last is not None else []) + [(row["record"], 0)], row["record"]


def _seen(row, seen):
    return [(row["arrival"], seen is None)], True


def _latest(row, top):
    passes = top is None or row["ts"] > top
    return ([(row["arrival"],)] if passes else []), row["ts"] if passes else top


@pytest.mark.parametrize("cuts", [[], [1, 2, 90, 250]])
@pytest.mark.parametrize("make, columns, step", [
    (lambda: S.DailyGate(ttl_ms=None), ["arrival", "uv_ct"], _gate), (lambda: S.DailyLogin(), ["arrival", "uu_ct", "back_ct"], _login),
    (lambda: S.NewVisitorRepair(ttl_ms=None), ["arrival", "is_new_fixed"], _repair),
    (lambda: S.Retract(ttl_ms=None), ["record", "is_retract"], _retract),
    (lambda: S.FirstSeen(), ["arrival", "is_first"], _seen), (lambda: S.MonotoneLatest("ts", ttl_ms=None), ["arrival"], _latest)])
def test_buckets_against_a_machine_a_key(make, columns, step, cuts):
    rows = _rows()
    got = _run(make(), rows, cuts)
    assert sorted(map(tuple, got[columns].to_numpy(object).tolist())) == _machine(rows, step)


def test_expired_values_are_forgotten_a_key():
    rows = pd.DataFrame({"arrival": range(5), "key": ["a", "b", "b", "a", "b"], "ts": [0] * 5, "record": list("vwxyz")})
    times = [0, 9_000, 12_000]
    got = _run(S.Retract(ttl_ms=10_000), rows, [2, 3], times.__getitem__)
    # a was written at 0 and is gone at 12 s; b was written again at 9 s
    assert sorted(zip(got["record"], got["is_retract"])) == [("v", 0), ("w", 0), ("w", 1), ("x", 0), ("x", 1), ("y", 0), ("z", 0)]


def test_missing_times():
    ts = [5.0, None, 3.0, 6.0, None, 2 * DAY]
    rows = pd.DataFrame({"arrival": range(6), "key": [None] * 6, "ts": ts})
    for cuts in ([], [2]):
        assert sorted(_run(S.MonotoneLatest("ts", ttl_ms=None), rows, cuts)["arrival"]) == [0, 3, 5]
        assert _run(S.DailyGate(ttl_ms=None), rows, cuts).sort_values("arrival")["uv_ct"].tolist() == [1, 0, 1, 0, 0, 1]


@pytest.mark.parametrize("starts, others", [(2, 0), (0, 2), (1, 1)])
def test_log_split_of_a_bucket_with_starts_only(starts, others):
    from tidemill.streaming.side_outputs import LogSplit

    n = starts + others
    rows = pd.DataFrame({"arrival": range(n), "mid": "m", "is_new": "1", "ts": 1000, "err": None, "start": ["s"] * starts + [None] * others,
                         "page": [None] * starts + ["p"] * others, "displays": None, "actions": None})
    out, _ = LogSplit(None).process(rows, np.zeros(n, int), np.array([None], object))
    assert sorted(out["topic"]) == ["page"] * others + ["start"] * starts
    assert sorted(out["body"]) == ["p"] * others + ["s"] * starts


class _Parts:
    """A map state that counts the bytes written to it."""

    def __init__(self):
        self.held, self.bytes, self.most = {}, 0, 0

    def getMapState(self, name, key, value, ttl_ms=None):  # noqa: N802
        return self

    def iterator(self):
        return iter([((n,), v) for (n,), v in reversed(self.held.items())])

    def updateValue(self, key, value):  # noqa: N802
        self.held[key], self.bytes = value, self.bytes + len(value[1])
        self.most = max(self.most, len(self.held))

    def removeKey(self, key):  # noqa: N802
        del self.held[key]


def test_state_in_parts_writes_what_changes_and_equals_a_machine_a_key():
    """Many micro-batches over many keys: a part each, merged by levels, with the values of one table."""
    rows = _rows(4000, 2500)
    rows["key"] = rows["key"].where(rows["arrival"] % 9 > 0, "hot")
    cuts = list(range(20, 4000, 20))
    parts, one = _Parts(), _Handle()
    processor = S.Retract(ttl_ms=None, parts=True)
    processor.init(parts)
    whole, written = S.Retract(ttl_ms=None), 0
    whole.init(one)
    keyed = rows.assign(**{S._KEY: rows["key"].map(lambda k: json.dumps({"key": k})), S._BUCKET: 0})
    out = []
    for low, high in zip([0, *cuts], [*cuts, len(rows)]):
        out += list(processor.handleInputRows((0,), iter([keyed.iloc[low:high]]), _Clock(0)))
        list(whole.handleInputRows((0,), iter([keyed.iloc[low:high]]), _Clock(0)))
        written += len(one.state.value[0])
    assert sorted(map(tuple, pd.concat(out)[["record", "is_retract"]].to_numpy(object).tolist())) == _machine(rows, _retract)
    assert parts.most <= 3 * S.MERGE and parts.bytes < written / 3
    levels = [parts.held[n][0] for n in sorted(parts.held)]
    assert levels == sorted(levels, reverse=True) and max(levels) == 2


def test_parts_forget_expired_values_a_key():
    rows = pd.DataFrame({"arrival": range(5), "key": ["a", "b", "b", "a", "b"], "ts": [0] * 5, "record": list("vwxyz")})
    keyed = rows.assign(**{S._KEY: rows["key"], S._BUCKET: 0})
    processor, out = S.Retract(ttl_ms=10_000, parts=True), []
    processor.init(_Parts())
    for low, high, now in ((0, 2, 0), (2, 3, 9_000), (3, 5, 12_000)):
        out += list(processor.handleInputRows((0,), iter([keyed.iloc[low:high]]), _Clock(now)))
    got = pd.concat(out)
    assert sorted(zip(got["record"], got["is_retract"])) == [("v", 0), ("w", 0), ("w", 1), ("x", 0), ("x", 1), ("y", 0), ("z", 0)]


def test_corrected_details_keep_their_values(spark, tmpdir_path):
    """Nulls, quotes and decimals go through the state, over several micro-batches."""
    import os
    import time
    from decimal import Decimal as D

    from tidemill.streaming import jobs

    schema = "detail_id string, arrival long, order_id long, sku_id long, et_ms long, split_total_amount decimal(18,4)"
    rows = [('a"],', 1, 2**60 + 1, None, 5, D("12345678901234.5678")), ('a"],', 2, 2**60 + 1, 7, None, None), (None, 1, None, 1, 1, D("-0.0001")),
            (None, 2, 3, 2, 2, D("2")), ('a"],', 3, 1, 8, 0, D("1.5"))]
    path = os.path.join(tmpdir_path, "details")
    for k in range(3):
        spark.createDataFrame([r for r in rows if r[1] == k + 1], schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    corrected = jobs.retract_stream(stream, ttl_ms=None)
    query, out = jobs.to_topic(spark, corrected, f"test/{os.path.basename(tmpdir_path)}", ends=True)
    assert query.awaitTermination(180)
    got = [tuple(r) for r in spark.read.schema(corrected.schema).parquet(out).collect()]
    again = [(*r[:5], None if r[5] is None else -r[5], 1) for r in (rows[0], rows[1], rows[2])]
    assert sorted(got, key=repr) == sorted([(*r, 0) for r in rows] + again, key=repr)


def test_topics_and_streams_leave_no_shuffle_files(spark, tmpdir_path):
    """Shuffles are removed with the write or micro-batch that made them, and the rows put in order lie once on disk."""
    import os

    from tidemill.plans import adapters as AD
    from tidemill.streaming import jobs

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(k).getName() for k in range(files.size())) if n.startswith("shuffle_")}

    before = shuffles()
    df = spark.range(3000).selectExpr("id as arrival", "cast(id % 700 as string) as detail_id", "id as order_id").repartition(4)
    folder = os.path.join(tmpdir_path, "tables")
    df.limit(1).write.parquet(folder)
    spark.conf.set("spark.tidemill.topicRows", "1000")
    try:
        path = AD.topic_path(spark, folder, "some", lambda s, d: df, order="arrival", closing=lambda rows: rows.where("arrival = 0").selectExpr(
            "arrival + 3000 as arrival", "detail_id", "order_id"))
    finally:
        spark.conf.unset("spark.tidemill.topicRows")
    assert sorted(r.arrival for r in spark.read.parquet(path).collect()) == list(range(3001))
    assert not [f for f in os.listdir(f"{path}-made") if f.endswith(".parquet")]
    stream = spark.readStream.schema("arrival long, detail_id string, order_id long").option("maxFilesPerTrigger", AD.TOPIC_FILES).parquet(path)
    query, _ = jobs.to_topic(spark, jobs.retract_stream(stream, ttl_ms=None), f"test/{os.path.basename(tmpdir_path)}", ends=True)
    assert query.awaitTermination(180)
    assert not shuffles() - before


def test_a_replay_of_windows_writes_them_once(spark, tmpdir_path):
    """No batch behind the last rows, and one batch needs no window function to find the newest rows."""
    import os

    from pyspark.sql import functions as F

    from tidemill.streaming import jobs

    path = os.path.join(tmpdir_path, "rows")
    spark.range(100).selectExpr("timestamp_millis(id * 1000) as et", "id % 3 as k").write.parquet(path)
    rows = spark.readStream.schema("et timestamp, k long").parquet(path).withWatermark("et", "0 seconds")
    windows = rows.groupBy(F.window("et", "10 seconds").alias("w"), "k").count().select(F.col("w.start").alias("stt"), "k", "count")
    query, table = jobs.to_table(spark, windows, f"test/{os.path.basename(tmpdir_path)}", ends=True, unload=True)
    assert query.awaitTermination(120)
    assert os.listdir(table) == ["batch=0"]
    got = jobs.read_table(spark, table, windows.schema, ["stt", "k"])
    assert sorted((r.stt.second % 60, r.k, r["count"]) for r in got.collect()) == sorted(
        (r.stt.second % 60, r.k, r["count"]) for r in spark.read.parquet(path).groupBy(F.window("et", "10 seconds").alias("w"), "k").count()
        .select(F.col("w.start").alias("stt"), "k", "count").collect())
    assert "row_number" not in got._jdf.queryExecution().toString()
