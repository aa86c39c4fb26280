"""Reference-shaped records derived from the driver tables.

The driver tables are a TPC-H-like schema plus an ``events`` log; the jobs of
the reference read an app log, change envelopes and order details.  These
adapters derive such records *from the driver tables* with plain SQL
expressions, so every query's work grows with the tables.  The derivation rules
(which field comes from which column) are written once, as SQL expression
text, and evaluated by Spark (``selectExpr``) and by the DuckDB oracle
(``SELECT``) alike; the operators under test are written separately on each side.

``events`` columns: event_id (arrival order), ts (TIMESTAMP_NTZ), user_id,
event_type (view/click/purchase/signup/error), value, props = ``{"k": int}``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Raise it when a rule that builds a topic changes.
ADAPTER_VERSION = 3

__all__ = ["load", "events_base", "app_log_fields", "app_log_json", "ods_fields", "cdc_envelopes",
           "order_details", "DIALECT", "APP_LOG", "ODS", "ODS_COLUMNS", "SQL"]

# Dialect-specific leaves: epoch ms of ``ts`` and the integer ``k`` of props.
DIALECT = {
    "spark": {"ms": "timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)",
              "k": "cast(get_json_object(props, '$.k') as int)"},
    "duck": {"ms": "(epoch_us(ts) // 1000)",
             "k": "cast(json_extract_string(props, '$.k') as int)"},
}

# ---------------------------------------------------------------- app log (pipeline R)
# Over: event_id, ts_ms, user_id, event_type, value, k.
APP_LOG = {
    "arrival": "event_id",
    "mid": "concat('mid_', cast(user_id as string))",
    "uid": "case when k % 9 = 0 then '' else cast(user_id as string) end",
    "vc": "concat('v2.', cast(k % 3 as string))",
    "ch": "concat('ch', cast(k % 4 as string))",
    "ar": "concat('ar', cast(user_id % 5 as string))",
    "is_new": "case when k % 2 = 1 then '1' else '0' end",
    "is_start": "(event_type = 'signup' and k % 3 = 0)",
    "page_id": ("case event_type when 'view' then 'home' when 'click' then 'good_detail' "
                "when 'purchase' then 'cart' when 'signup' then 'mine' else 'search' end"),
    "last_page_id": ("case when event_type = 'signup' then 'login' when k < 10 then null "
                     "when event_type = 'error' then 'search' else 'home' end"),
    "during_time": "cast(floor(value * 1000) as bigint)",
    "n_displays": "case when event_type = 'view' then k % 3 else -1 end",
    "n_actions": "case when event_type = 'purchase' then k % 3 else -1 end",
    "err_code": "case when event_type = 'error' then cast(1000 + k as string) else null end",
    "start_entry": "case when k % 2 = 0 then 'icon' else 'notice' end",
}

# ---------------------------------------------------------------- ODS rows (pipeline G)
ODS = {
    "tbl": ("case when event_type = 'view' then 'ods_user_visit_log' "
            "when event_type = 'click' then 'ods_page_click_log' "
            "when event_type = 'purchase' then 'ods_order_pay_log' "
            "when event_type = 'signup' then 'ods_crowd_attribute_log' "
            "when k % 2 = 0 then 'ods_product_interaction_log' else 'ods_search_log' end"),
    "op": ("case when event_id % 20 = 19 then 't' when event_id % 4 = 0 then 'r' "
           "when event_id % 4 = 1 then 'c' when event_id % 4 = 2 then 'u' else 'd' end"),
    "log_id": "cast(event_id as string)",
    "evt_time": "case when k = 1 then null else cast(ts_ms as string) end",
    "visitor_id": "case when k = 2 then ' ' else cast(user_id as string) end",
    "terminal_type": "case when k % 2 = 0 then 'pc' else 'wireless' end",
    "visit_object_type": "case k % 3 when 0 then 'shop' when 1 then 'product' else 'page' end",
    "visit_object_id": "cast(k % 10 as string)",
    "traffic_source_first": ("case k % 4 when 0 then 'search' when 1 then 'ads' "
                             "when 2 then 'direct' else null end"),
    "traffic_source_second": "concat('s', cast(k % 6 as string))",
    "is_new_visitor": "case when k % 10 < 3 then '1' else '0' end",
    "page_view": "cast(1 + k % 5 as string)",
    "stay_time": "cast(cast(floor(value * 10) as int) as string)",
    "product_id": "cast(k % 10 as string)",
    "interact_type": "case when k % 4 < 2 then 'add_cart' else 'collect' end",
    "is_cancel": "case when k % 10 = 0 then '1' when k % 10 = 4 then null else '0' end",
    "order_id": "cast(event_id as string)",
    "buyer_id": "cast(user_id as string)",
    "pay_amount": "cast(cast(value as decimal(18,2)) as string)",
    "is_paid": "case when k % 10 < 6 then '1' when k % 10 = 9 then null else '0' end",
    "keyword": ("case k % 5 when 0 then 'phone' when 1 then 'laptop' when 2 then 'shoes' "
                "when 3 then 'coffee' else 'book' end"),
    "is_click_result": "case when k % 10 < 4 then '1' else '0' end",
    "click_product_id": "case when k % 10 < 4 then cast(k % 10 as string) else null end",
    "page_id": "cast(k % 10 as string)",
    "module_name": "concat('m', cast(k % 5 as string))",
    "module_position": "case when k % 4 = 0 then null else concat('p', cast(k % 4 as string)) end",
    "guide_product_id": "case when k % 3 = 0 then null else cast(k % 10 as string) end",
    "gender": "case when k % 2 = 0 then 'M' else 'F' end",
    "age_range": ("case k % 4 when 0 then '18-24' when 1 then '25-34' when 2 then '35-44' "
                  "else '45+' end"),
    "city": "case when k % 9 = 0 then null else concat('c', cast(k % 9 as string)) end",
    "city_level": "concat('L', cast(k % 3 as string))",
    "taoqi_value": "cast(k * 10 as string)",
}

# The columns of each source table and the name of its event-time field.
ODS_COLUMNS = {
    "ods_user_visit_log": ("visit_time", ["log_id", "visitor_id", "terminal_type", "visit_object_type",
                                          "visit_object_id", "traffic_source_first", "traffic_source_second",
                                          "is_new_visitor", "page_view", "stay_time"]),
    "ods_product_interaction_log": ("interact_time", ["log_id", "visitor_id", "terminal_type", "product_id",
                                                      "interact_type", "is_cancel"]),
    "ods_order_pay_log": ("pay_time", ["log_id", "order_id", "buyer_id", "terminal_type", "product_id",
                                       "pay_amount", "is_paid"]),
    "ods_search_log": ("search_time", ["log_id", "visitor_id", "terminal_type", "keyword", "is_click_result",
                                       "click_product_id"]),
    "ods_page_click_log": ("click_time", ["log_id", "visitor_id", "terminal_type", "page_id", "module_name",
                                          "module_position", "guide_product_id"]),
    "ods_crowd_attribute_log": ("update_time", ["log_id", "visitor_id", "gender", "age_range", "city",
                                                "city_level", "taoqi_value"]),
}


def _select_list(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in exprs.items())


def SQL(kind: str) -> str:
    """DuckDB text of an adapter, as a sub-query over the ``events`` view."""
    d = DIALECT["duck"]
    base = (f"(SELECT event_id, ts, user_id, event_type, value, {d['ms']} AS ts_ms, {d['k']} AS k "
            f"FROM events)")
    if kind == "base":
        return base
    exprs = {"app_log": APP_LOG, "ods": ODS}[kind]
    return f"(SELECT event_id, ts, ts_ms, k, {_select_list(exprs)} FROM {base} b)"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def topic(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """The derived topic as a batch DataFrame (see :func:`topic_path`)."""
    return spark.read.parquet(topic_path(spark, sf_dir, name, build))


#: Rows of one step of a topic written in arrival order; ``spark.tidemill.topicRows`` overrides it.
TOPIC_ROWS = 1 << 20
#: Files of a step, which a stream takes at a time.
TOPIC_FILES = 8


def _write(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    from ..session import SHUFFLES_ONCE, settings

    with settings(df.sparkSession, SHUFFLES_ONCE):
        df.write.mode(mode).option("compression", "zstd").parquet(path)


def _write_in_order(df: DataFrame, path: str, order: str, closing=None) -> None:
    """Append ``df`` in steps of about ``TOPIC_ROWS`` rows along ``order``, each of at most ``TOPIC_FILES``
    files: a stream that takes so many files at a time replays the arrival order in bounded batches.
    ``closing(rows)``: rows that are added behind them."""
    spark = df.sparkSession
    _write(df, f"{path}-made")
    made = spark.read.parquet(f"{path}-made")
    if closing is not None:
        _write(closing(made), f"{path}-made", "append")
        made = spark.read.parquet(f"{path}-made")
    steps = -(-made.count() // int(spark.conf.get("spark.tidemill.topicRows", str(TOPIC_ROWS)))) or 1
    cuts = made.approxQuantile(order, [k / steps for k in range(1, steps)], 0.1 / steps) if steps > 1 else []
    bounds = [None, *sorted(set(cuts)), None]
    for k, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = made if low is None else made.where(F.col(order) > low)
        part = part if high is None else part.where((F.col(order) <= high) if low is not None else (F.col(order) <= high) | F.col(order).isNull())
        _write(part.repartition(TOPIC_FILES).sortWithinPartitions(order), path, "append" if k else "overwrite")


def topic_path(spark: SparkSession, sf_dir: str, name: str, build, order: str | None = None, closing=None) -> str:
    """A derived topic at rest: ``build(spark, sf_dir)`` written once as parquet
    under the shared checkpoint folder (``spark.checkpoint.dir``), then read.

    A topic is data at rest in the reference too; writing it also cuts the
    lineage so the optimizer cannot inline the record-building expressions
    into every downstream filter.  The folder name carries the source path, the
    sizes and times of all its files as the file system reports them, and
    ``ADAPTER_VERSION``, so a changed input or rule gets a new topic.  ``order``: the column along
    which it is written in bounded steps, for streams; ``closing(rows)`` makes rows that come last.
    """
    import hashlib

    from ..session import checkpoint_dir

    src = sf_dir.rstrip("/")
    fs_of, hadoop = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(src)
    stamp = [str(ADAPTER_VERSION), src]
    for table in sorted(folder.getFileSystem(fs_of).listStatus(folder), key=lambda x: x.getPath().getName()):
        files = table.getPath().getFileSystem(fs_of).listStatus(table.getPath())
        stamp += sorted(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}" for f in files)
    key = hashlib.sha256("|".join(stamp).encode()).hexdigest()[:16]
    path = f"{checkpoint_dir(spark).rstrip('/')}/topics/{name}-{key}"
    if order is not None:
        path = f"{path}-by-{order}-{spark.conf.get('spark.tidemill.topicRows', str(TOPIC_ROWS))}"
    done = hadoop.Path(f"{path}/_SUCCESS" if order is None else f"{path}-made/_ORDERED")
    if not done.getFileSystem(fs_of).exists(done):
        made = build(spark, sf_dir)
        if order is None:
            _write(made, path)
        else:
            _write_in_order(made, path, order, closing)
            done.getFileSystem(fs_of).delete(done.getParent(), True)  # the rows lie in the topic now
            done.getFileSystem(fs_of).create(done).close()
    return path


def events_base(events: DataFrame) -> DataFrame:
    d = DIALECT["spark"]
    return events.selectExpr("event_id", "ts", "user_id", "event_type", "value",
                             f"{d['ms']} AS ts_ms", f"{d['k']} AS k")


def app_log_fields(events: DataFrame) -> DataFrame:
    """Flat app-log fields, one row per event (the oracle's view of the log)."""
    return events_base(events).selectExpr("event_id", "ts", "ts_ms", "k",
                                          *[f"{e} AS {n}" for n, e in APP_LOG.items()])


def app_log_json(events: DataFrame, corrupt: bool = True) -> DataFrame:
    """The app log topic: ``(arrival, value)`` with ``value`` a JSON record
    shaped like the reference's log (common/page/start/err/displays/actions/ts).
    With ``corrupt``, every 50th arrival carries a truncated (unparseable) payload."""
    f = app_log_fields(events)
    disp = F.array(*[F.create_map(F.lit("display_type"), F.lit("promotion"),
                                  F.lit("item"), (F.col("k") + i).cast("string"),
                                  F.lit("pos_id"), F.lit(str(i + 1))) for i in range(2)])
    act = F.array(*[F.create_map(F.lit("action_id"), F.lit("cart_add"),
                                 F.lit("item"), (F.col("k") + i).cast("string")) for i in range(2)])
    rec = F.struct(
        F.struct("mid", "uid", "vc", "ch", "ar", "is_new").alias("common"),
        F.when(~F.col("is_start"), F.struct("page_id", "last_page_id",
                                             F.lit(None).cast("string").alias("item"),
                                             F.lit(None).cast("string").alias("item_type"),
                                             "during_time")).alias("page"),
        F.when(F.col("is_start"), F.create_map(F.lit("entry"), F.col("start_entry"))).alias("start"),
        F.when(F.col("err_code").isNotNull(),
               F.create_map(F.lit("error_code"), F.col("err_code"))).alias("err"),
        F.when(F.col("n_displays") >= 0, F.slice(disp, 1, F.col("n_displays"))).alias("displays"),
        F.when(F.col("n_actions") >= 0, F.slice(act, 1, F.col("n_actions"))).alias("actions"),
        F.col("ts_ms").alias("ts"),
    )
    staged = f.select("arrival", rec.alias("__rec"))
    js = F.to_json("__rec")
    if corrupt:
        js = F.when(F.col("arrival") % 50 == 7, F.substring(js, 1, 20)).otherwise(js)
    return staged.select("arrival", js.alias("value"))


def ods_fields(events: DataFrame) -> DataFrame:
    """Flat ODS fields per event (table, op and every candidate column)."""
    return events_base(events).selectExpr("event_id", "ts", "ts_ms", "k",
                                          *[f"{e} AS {n}" for n, e in ODS.items()])


def cdc_envelopes(events: DataFrame) -> DataFrame:
    """Change envelopes ``(arrival, op, before, after, source, ts_ms)``: each
    event becomes a change of one of the six source tables.  Update envelopes
    carry a stale before-image (terminal_type 'unknown')."""
    f = ods_fields(events)
    row = None
    stale = None
    for t, (time_name, cols) in ODS_COLUMNS.items():
        kv = [x for c in cols for x in (F.lit(c), F.col(c))] + [F.lit(time_name), F.col("evt_time")]
        kv_old = [x for c in cols for x in (F.lit(c), F.lit("unknown") if c == "terminal_type" else F.col(c))]
        kv_old += [F.lit(time_name), F.col("evt_time")]
        cond = F.col("tbl") == t
        row = F.when(cond, F.create_map(*kv)) if row is None else row.when(cond, F.create_map(*kv))
        stale = F.when(cond, F.create_map(*kv_old)) if stale is None else stale.when(cond, F.create_map(*kv_old))
    op = F.col("op")
    return f.select(
        F.col("event_id").alias("arrival"), op,
        F.when(op == "u", stale).when(op == "d", row).alias("before"),
        F.when(op.isin("r", "c", "u"), row).alias("after"),
        F.struct(F.lit("shop").alias("db"), F.col("tbl").alias("table"), F.col("ts_ms").alias("ts_ms")).alias("source"),
        F.col("ts_ms"))


# ---------------------------------------------------------------- order details (pipeline R trade jobs)
# lineitem plays the order-detail topic: detail id = (l_orderkey, l_linenumber); a repeated id
# is a corrected record.  Arrival order inside an id: the columns below (total at the driver's sf).
LINEITEM_ARRIVAL = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax"]

ORDER_DETAIL = {
    "detail_id": "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string))",
    "order_id": "l_orderkey",
    "sku_id": "l_partkey",
    "supp_id": "l_suppkey",
    "sku_num": "l_quantity",
    # inputs carry two decimals: cast each first so every product is exact in any engine
    "split_original_amount": "cast(cast(l_extendedprice as decimal(18,2)) as decimal(18,4))",
    "split_activity_amount": ("cast(cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(18,2))"
                              " as decimal(18,4))"),
    "split_coupon_amount": ("cast(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(18,2))"
                            " as decimal(18,4))"),
    "split_total_amount": ("cast(cast(l_extendedprice as decimal(18,2)) * (1 - cast(l_discount as decimal(18,2)))"
                           " as decimal(18,4))"),
    "et": "l_shipdate",
}


def order_details(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(*LINEITEM_ARRIVAL, *[f"{e} AS {n}" for n, e in ORDER_DETAIL.items()])
