"""Structured Streaming twins of the pipeline-R jobs.

A job has two steps, as in the reference's layers.  The gate (``*_gate``) is a keyed-state query
that appends its rows to a topic at rest (:func:`to_topic`, exactly once by the file sink); the
window step (``*_windows``) aggregates that topic and hands every changed window to an upsert by
window key (:func:`to_table`, update mode, idempotent per batch), so every window of a bounded
replay comes out, the last ones included.  Both keep their checkpoints under the shared
``spark.checkpoint.dir``: a restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from ..functions.text import is_empty, word_tokens
from ..functions.time import window_bounds
from ..operators import aggregate as A
from ..session import SHUFFLES_ONCE, settings, state_dir
from .stateful import DAY_MS, DailyGate, DailyLogin, FirstSeen, MonotoneLatest, NewVisitorRepair, Retract, apply_processor

__all__ = ["event_time", "monotone", "bounded", "page_view_gate", "page_view_windows", "home_detail_gate",
           "home_detail_windows", "login_gate", "login_windows", "cart_gate", "cart_windows", "new_visitor_stream",
           "retract_stream", "sku_order_windows", "province_order_windows", "keyword_windows", "first_seen_stream",
           "latest_stream", "interval_join_stream", "start", "to_topic", "to_table"]


# ---------------------------------------------------------------- watermarks
def event_time(df: DataFrame, ms: str = "ts", out: str = "et") -> DataFrame:
    """Event time column (TIMESTAMP) from epoch ms, as watermarks require."""
    return df.withColumn(out, F.timestamp_millis(F.col(ms)))


def monotone(df: DataFrame, et: str = "et") -> DataFrame:
    """Monotonous timestamps (no lateness allowed)."""
    return df.withWatermark(et, "0 seconds")


def bounded(df: DataFrame, seconds: int, et: str = "et") -> DataFrame:
    """Bounded out-of-orderness; rows later than this are dropped (as in the reference)."""
    return df.withWatermark(et, f"{seconds} seconds")


# ---------------------------------------------------------------- gates (keyed state)
_PAGE = "arrival long, mid string, vc string, ch string, ar string, is_new string, last_page_id string, during_time long, ts long"


def _names(ddl: str) -> list[str]:
    return [c.split()[0] for c in ddl.split(", ")]


def page_view_gate(pages: DataFrame) -> DataFrame:
    """The daily gate of each device over the page stream."""
    return apply_processor(pages.select(*_names(_PAGE)), ["mid"], DailyGate(flag="uv_ct"), _PAGE + ", uv_ct long")


def home_detail_gate(pages: DataFrame) -> DataFrame:
    """One daily gate per (device, page) of the home and detail pages; fired rows only."""
    p = pages.where(F.col("page_id").isin("home", "good_detail")).select("arrival", "mid", "page_id", "ts")
    return apply_processor(p, ["mid", "page_id"], DailyGate(flag="fire", only_fired=True),
                           "arrival long, mid string, page_id string, ts long, fire long")


def login_gate(pages: DataFrame) -> DataFrame:
    """P16 + D10: first login of a day, and users who return after eight days or more."""
    logins = pages.where(~is_empty("uid") & ((F.col("last_page_id") == "login") | is_empty("last_page_id")))
    return apply_processor(logins.select("arrival", "uid", "ts"), ["uid"], DailyLogin(),
                           "arrival long, uid string, ts long, uu_ct long, back_ct long")


def cart_gate(cart_adds: DataFrame) -> DataFrame:
    """Daily-unique cart users."""
    return apply_processor(cart_adds.select("arrival", "user_id", "ts"), ["user_id"], DailyGate(flag="uu", only_fired=True),
                           "arrival long, user_id long, ts long, uu long")


def new_visitor_stream(records: DataFrame, ttl_ms: int | None = 10_000) -> DataFrame:
    """D6 on the log stream (per device)."""
    return apply_processor(records.select("arrival", "mid", "is_new", "ts"), ["mid"], NewVisitorRepair(ttl_ms=ttl_ms),
                           "arrival long, mid string, is_new string, ts long, is_new_fixed string")


_DETAIL_AMOUNTS = ["split_original_amount", "split_activity_amount", "split_coupon_amount", "split_total_amount"]
_DETAIL = ("detail_id string, arrival long, order_id long, sku_id long, province_id long, et_ms long, "
           + ", ".join(f"{a} decimal(18,4)" for a in _DETAIL_AMOUNTS))


def retract_stream(details: DataFrame, ttl_ms: int | None = 10_000) -> DataFrame:
    """D1 on a stream of order details (decimals stay decimals in the state)."""
    names = [c for c in _names(_DETAIL.replace("(18,4)", "")) if c in details.columns]
    d = details.select(*[F.col(n).cast("decimal(18,4)").alias(n) if n in _DETAIL_AMOUNTS else F.col(n) for n in names])
    held = [f for f in d.schema if f.name != "detail_id"]  # without names and key, as all of it lies in the state
    records = d.select("detail_id", "arrival", F.to_json(F.array(*[F.col(f.name).cast("string") for f in held])).alias("record"))
    out = apply_processor(records, ["detail_id"], Retract(ttl_ms=ttl_ms, parts=True), "detail_id string, arrival long, record string, is_retract long")
    # with an option of its own the record is parsed once, not once a field
    r = out.select("detail_id", F.from_json("record", "array<string>", {"mode": "FAILFAST"}).alias("r"), "is_retract")
    value = {f.name: F.col("r")[k].cast(f.dataType) for k, f in enumerate(held)} | {"detail_id": F.col("detail_id")}
    signed = lambda n: F.when(F.col("is_retract") == 1, -value[n]).otherwise(value[n]).cast("decimal(18,4)")
    return r.select(*[(signed(n) if n in _DETAIL_AMOUNTS else value[n]).alias(n) for n in names], "is_retract")


def first_seen_stream(unpacked: DataFrame) -> DataFrame:
    """Whether a visitor id was never seen before (``arrival``, ``visitor_id``)."""
    return apply_processor(unpacked.where("visitor_id is not null").select("arrival", "visitor_id"), ["visitor_id"], FirstSeen(),
                           "arrival long, visitor_id string, is_first boolean")


def latest_stream(records: DataFrame, key: str, ttl_ms: int | None = DAY_MS) -> DataFrame:
    """D3: records whose ``ts_ms`` exceeds every earlier one of their key."""
    return apply_processor(records.select("arrival", key, "ts_ms"), [key], MonotoneLatest(ttl_ms=ttl_ms),
                           f"arrival long, {key} long, ts_ms long")


# ---------------------------------------------------------------- windows over topics at rest
def page_view_windows(gated: DataFrame, size: str = "10 seconds", lateness_s: int = 3) -> DataFrame:
    """A6 with the 3 s bounded watermark."""
    beans = gated.select("vc", "ch", "ar", "is_new", "uv_ct", is_empty("last_page_id").cast("long").alias("sv_ct"),
                         F.lit(1).cast("long").alias("pv_ct"), F.coalesce("during_time", F.lit(0)).alias("during_time"),
                         F.timestamp_millis("ts").alias("et"))
    return A.page_view_window(bounded(beans, lateness_s), "et", size)


def home_detail_windows(gated: DataFrame, size: str = "5 seconds") -> DataFrame:
    """A4: global windows, monotone watermark."""
    g = gated.select((F.col("page_id") == "home").cast("long").alias("home_uv_ct"),
                     (F.col("page_id") == "good_detail").cast("long").alias("good_detail_uv_ct"),
                     F.timestamp_millis("ts").alias("et"))
    return A.global_sum_window(monotone(g), "et", size, {"home_uv_ct": "home_uv_ct", "good_detail_uv_ct": "good_detail_uv_ct"})


def _window_time(rows: DataFrame, processing_time: bool) -> DataFrame:
    return rows.withColumn("pt", F.current_timestamp() if processing_time else F.timestamp_millis("ts")).withWatermark("pt", "0 seconds")


def login_windows(gated: DataFrame, size: str = "1 second", processing_time: bool = True) -> DataFrame:
    """A5: windows of processing time or, for replays, of the records' time."""
    return A.global_sum_window(_window_time(gated, processing_time), "pt", size, {"back_ct": "back_ct", "uu_ct": "uu_ct"})


def cart_windows(gated: DataFrame, size: str = "5 seconds", processing_time: bool = True) -> DataFrame:
    """A3: users per window of processing time or, for replays, of the records' time."""
    return A.global_count_window(_window_time(gated, processing_time), "pt", size, "cart_add_uu_ct")


def sku_order_windows(corrected: DataFrame, size: str = "5 seconds") -> DataFrame:
    """A1 over retract-corrected details, monotone watermark; dimensions join the merged windows."""
    return A.sku_order_window(monotone(event_time(corrected, "et_ms", "et")), "et", size)


def province_order_windows(corrected: DataFrame, size: str = "10 seconds") -> DataFrame:
    """A2: order amount and distinct orders; a stream counts the members of a set."""
    return A.province_order_window(monotone(event_time(corrected, "et_ms", "et")), "et", size, distinct="set")


def keyword_windows(searches: DataFrame, size: str = "3 days", lateness_s: int = 5) -> DataFrame:
    """P17 + X1 + A7 with the SQL job's 5 s watermark (``searches``: page map + et)."""
    p = F.col("page")
    kw = searches.where((p["last_page_id"] == "search") & (p["item_type"] == "keyword") & p["item"].isNotNull())
    words = bounded(kw, lateness_s).select(F.explode(word_tokens(p["item"])).alias("keyword"), "et")
    g = words.groupBy(F.window("et", size).alias("window"), "keyword").agg(F.count(F.lit(1)).alias("keyword_count"))
    return g.select(*window_bounds("window")[:2], F.date_format("window.start", "yyyyMMdd").alias("cur_date"),
                    "keyword", "keyword_count")


def interval_join_stream(left: DataFrame, right: DataFrame, key: str, before_s: int, after_s: int, lateness_s: int = 0,
                         prefix: str = "info_") -> DataFrame:
    """J5 between two streams of (key, ts_ms, ...): inner join within the interval; both sides carry a
    watermark, so Spark drops the state that no later record can meet."""
    a = bounded(event_time(left, "ts_ms", "et"), lateness_s)
    b = bounded(event_time(right, "ts_ms", "et"), lateness_s)
    b = b.select(*[F.col(c).alias(prefix + c) for c in b.columns])
    within = F.expr(f"{prefix}et >= et - interval {before_s} seconds and {prefix}et <= et + interval {after_s} seconds")
    return a.join(b, (F.col(key) == F.col(prefix + key)) & within).drop("et", prefix + "et")


# ---------------------------------------------------------------- running
_SWITCH = "spark.sql.streaming.noDataMicroBatches.enabled"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A restart needs the last batch only; with the default of 100, state that changes is kept that often.
_KEPT = {"spark.sql.streaming.minBatchesToRetain": "3"}
_UNLOAD = {"spark.sql.streaming.stateStore.unloadOnCommit": "true"}


def start(spark: SparkSession, result: DataFrame, name: str, sink: str = "parquet", output_mode: str = "append",
          trigger: dict | None = None, foreach_batch=None, path: str | None = None, options: dict | None = None,
          ends: bool = False, partition_by: list[str] | None = None, unload: bool = False) -> StreamingQuery:
    """Start a query with its checkpoint under the shared folder.

    ``trigger`` e.g. ``{"availableNow": True}`` or ``{"processingTime": "30 seconds"}``; ``options`` go
    to the sink (servers, topic).  ``ends``: a bounded replay of a keyed state with TTL, whose
    expiry would ask for empty batches for ever; they are off for this query alone.  ``unload``: a replay
    with much state in few micro-batches, whose executors keep no copy of it on their disks between
    them, but read it from the checkpoint again.  A query takes a
    copy of the session's settings when it starts, so the RocksDB state store, that switch and what is
    kept on disk are set for the start and put back.
    """
    w = result.writeStream.outputMode(output_mode).option("checkpointLocation", state_dir(spark, name))
    w = w.trigger(**(trigger or {"availableNow": True})).queryName(name.replace("/", "-"))
    for k, v in (({"compression": "zstd"} if sink == "parquet" else {}) | (options or {})).items():
        w = w.option(k, v)
    w = w.partitionBy(*partition_by) if partition_by else w
    wanted = {_STORE: _ROCKS} | SHUFFLES_ONCE | _KEPT | ({_SWITCH: "false"} if ends else {}) | (_UNLOAD if unload else {})
    with settings(spark, wanted):
        if foreach_batch is not None:
            return w.foreachBatch(foreach_batch).start()
        return w.format(sink).start(path) if path else w.format(sink).start()


def to_topic(spark: SparkSession, result: DataFrame, name: str, trigger: dict | None = None, ends: bool = False,
             unload: bool = False) -> tuple[StreamingQuery, str]:
    """Append a stream to a topic at rest under the shared folder; (query, path)."""
    path = state_dir(spark, name) + "-topic"
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(jpath)  # readable before the first batch
    return start(spark, result, name, path=path, trigger=trigger, ends=ends, unload=unload), path


def to_table(spark: SparkSession, windows: DataFrame, name: str, trigger: dict | None = None, ends: bool = False,
             unload: bool = False) -> tuple[StreamingQuery, str]:
    """Upsert the windows a stream changes: each batch writes the windows it touched as one part of
    its own (a repeated batch writes the same part again); (query, path).  A replay that ``ends`` has
    written all windows with its last rows and needs no batch that only drops their state."""
    path = state_dir(spark, name) + "-table"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/batch={number}")

    return start(spark, windows, name, output_mode="update", trigger=trigger, foreach_batch=write, ends=ends, unload=unload), path


def read_table(spark: SparkSession, path: str, schema, keys: list[str]) -> DataFrame:
    """The newest row of every window key; without any batch, no rows.  One batch has one row a key."""
    from pyspark.sql.types import IntegerType

    try:
        rows = spark.read.schema(StructType([*schema.fields, StructField("batch", IntegerType())])).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    parts = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    if sum(p.getPath().getName().startswith("batch=") for p in parts) == 1:
        return rows.drop("batch")
    order = Window.partitionBy(*keys).orderBy(F.col("batch").desc())
    return rows.withColumn("newest", F.row_number().over(order)).where("newest = 1").drop("newest", "batch")
