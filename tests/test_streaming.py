"""Batch == stream: each stateful processor, driven by a file-backed stream in several
micro-batches (``maxFilesPerTrigger=1``, ``availableNow``), must emit exactly what the batch
operator computes, and every window of a bounded replay must come out."""

import os
import time
import uuid

from pyspark.sql import functions as F

from tidemill.operators import dedup as D
from tidemill.plans import adapters as AD
from tidemill.plans import queries as Q
from tidemill.plans import retail as R
from tidemill.streaming import jobs as S
from tidemill.streaming.stateful import DailyGate, DailyLogin, apply_processor
from table_paths import SF_SMALL

SWITCH = "spark.sql.streaming.noDataMicroBatches.enabled"


def _as_stream(spark, df, path, n_files=3, order="arrival"):
    """Write ``df`` as ``n_files`` parquet files, one after the other in arrival
    order (the file source replays files by modification time), and stream them back."""
    df = df.cache()
    lo, hi = df.agg(F.min(order), F.max(order)).first()
    step = (hi - lo) // n_files + 1
    for i in range(n_files):
        part = df.where((F.col(order) >= lo + i * step) & (F.col(order) < lo + (i + 1) * step))
        part.coalesce(1).sortWithinPartitions(order).write.mode("append").parquet(path)
        time.sleep(1.1)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _topic(spark, result):
    query, path = S.to_topic(spark, result, f"test/{uuid.uuid4().hex[:8]}", ends=True)
    assert query.awaitTermination(120)
    assert spark.conf.get(SWITCH, "true") == "true"  # the session's own setting stays
    return spark.read.schema(result.schema).parquet(path)


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_daily_gate_stream_equals_batch(spark, tmpdir_path):
    cols = ["arrival", "mid", "ts"]
    pages = Q.page_rows(spark, SF_SMALL).select(*cols)
    stream = _as_stream(spark, pages, os.path.join(tmpdir_path, "pages"))
    got = _topic(spark, apply_processor(stream, ["mid"], DailyGate(flag="uv_ct"), "arrival long, mid string, ts long, uv_ct long"))
    want = D.daily_unique(pages, ["mid"], ["arrival"], "ts", "uv_ct")
    assert _rows(got, cols + ["uv_ct"]) == _rows(want, cols + ["uv_ct"])


def test_login_stream_flags_equal_batch(spark, tmpdir_path):
    pages = Q.page_rows(spark, SF_SMALL)
    logins = pages.where("uid <> '' AND (last_page_id = 'login' OR last_page_id IS NULL)").select("arrival", "uid", "ts")
    stream = _as_stream(spark, logins, os.path.join(tmpdir_path, "logins"))
    got = _topic(spark, apply_processor(stream, ["uid"], DailyLogin(), "arrival long, uid string, ts long, uu_ct long, back_ct long"))
    want = D.daily_login(logins, "uid", ["arrival"], "ts")
    cols = ["arrival", "uid", "uu_ct", "back_ct"]
    assert _rows(got, cols) == _rows(want, cols)


def test_new_visitor_stream_equals_batch_without_ttl(spark, tmpdir_path):
    clean = Q.app_log_streams(spark, SF_SMALL)["clean_all"]
    recs = clean.select("arrival", F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"), "ts")
    stream = _as_stream(spark, recs, os.path.join(tmpdir_path, "recs"))
    got = _topic(spark, S.new_visitor_stream(stream, ttl_ms=None))
    want = D.repair_new_visitor(recs, "mid", ["arrival"], "ts", "is_new", out="is_new_fixed")
    cols = ["arrival", "mid", "is_new", "is_new_fixed"]
    assert _rows(got, cols) == _rows(want, cols)


def test_expired_state_is_never_read(spark, tmpdir_path):
    """A device silent for longer than the TTL starts anew, with or without a batch in between."""
    path = os.path.join(tmpdir_path, "ttl")
    schema = "arrival long, mid string, is_new string, ts long"
    day = 86_400_000

    def put(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    name = f"test/{uuid.uuid4().hex[:8]}"

    def replay():
        stream = spark.readStream.schema(schema).parquet(path)
        query, out = S.to_topic(spark, S.new_visitor_stream(stream, ttl_ms=4_000), name, ends=True)
        assert query.awaitTermination(120)
        return out

    put([(1, "a", "1", 0), (2, "b", "1", 0)])
    replay()
    put([(3, "b", "1", day)])
    replay()
    time.sleep(6)
    put([(4, "a", "1", day)])
    out = replay()
    got = {r.arrival: r.is_new_fixed for r in spark.read.parquet(out).collect()}
    assert got[1] == got[2] == "1" and got[4] == "1"


def test_retract_stream_equals_batch_and_keeps_types(spark, tmpdir_path):
    det = Q.details(spark, SF_SMALL)
    det = det.withColumn("arrival", F.row_number().over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.orderBy(*AD.LINEITEM_ARRIVAL)).cast("long"))
    big = 9007199254740993
    det = det.withColumn("order_id", F.col("order_id") + F.lit(big)).withColumn(
        "et_ms", F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), "et"))
    stream = _as_stream(spark, det, os.path.join(tmpdir_path, "det"))
    got = _topic(spark, S.retract_stream(stream, ttl_ms=None))
    amounts = ["split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]
    want = D.retract_duplicates(det, ["detail_id"], ["arrival"], amounts)
    cols = ["detail_id", "arrival", "order_id", "is_retract", *amounts]
    assert _rows(got, cols) == _rows(want, cols)


def test_every_window_of_a_replay_comes_out(spark, tmpdir_path):
    pages = Q.page_rows(spark, SF_SMALL)
    stream = _as_stream(spark, pages.orderBy("ts").select("*", F.col("ts").alias("by")), os.path.join(tmpdir_path, "pv"), order="by")
    query, path = S.to_topic(spark, S.page_view_gate(stream), f"test/{uuid.uuid4().hex[:8]}", ends=True)
    assert query.awaitTermination(120)
    gated = spark.read.parquet(path)
    windows = S.page_view_windows(spark.readStream.schema(gated.schema).parquet(path))
    query, table = S.to_table(spark, windows, f"test/{uuid.uuid4().hex[:8]}")
    assert query.awaitTermination(120)
    got = S.read_table(spark, table, windows.schema, ["stt", "vc", "ch", "ar", "is_new"])
    cols = ["stt", "vc", "ch", "ar", "is_new", "sv_ct", "pv_ct", "dur_sum"]
    assert _rows(got, cols) == _rows(R.page_view_job(pages), cols)


def test_rows_of_an_empty_replay(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "none")
    spark.createDataFrame([], "arrival long, mid string, ts long").write.parquet(path)
    stream = spark.readStream.schema("arrival long, mid string, ts long").parquet(path)
    got = _topic(spark, apply_processor(stream, ["mid"], DailyGate(flag="uv_ct"), "arrival long, mid string, ts long, uv_ct long"))
    assert got.count() == 0
