"""Sinks (K1–K9).

Each sink is a DataFrame-level function (what gets written) plus a writer.  The
merge logic of the upsert sinks (K5, K7, K8) is a pure DataFrame function so it
can be tested against SQL and reused inside ``foreachBatch``; the writers are
idempotent per batch id, which together with the streaming checkpoint gives
exactly-once results even when executors are lost and batches are replayed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.keys import camel_to_snake, md5_key
from ..functions.time import ms_to_wall, to_millis
from ..operators.dedup import keep_last, latest_non_null

__all__ = ["topic_sink", "write_routed", "json_lines", "olap_load", "upsert_merge", "upsert_write",
           "day_partition", "write_day_partitioned", "pack_days", "dim_upsert", "dim_config_route",
           "config_versions", "dim_config_route_as_of", "dim_config_route_stream", "delete_keys", "console"]


# ---------------------------------------------------------------- K1 / K3 topic sinks
def topic_sink(df: DataFrame, target: str | None = None, topic: str | None = None, topic_col: str | None = None,
               kafka_servers: str | None = None, fmt: str = "json", name: str | None = None, trigger: dict | None = None):
    """K1/K2/K3: write records as JSON strings to a topic.

    With ``kafka_servers`` the Kafka sink is used (``topic`` option, or a
    ``topic`` column for per-row routing); otherwise a directory stands for the
    topic (``target/topic=<name>/``), which is how tests and replays run.
    A streaming frame starts a query called ``name`` and returns it; a batch
    frame returns the writer's result.
    """
    payload_cols = [c for c in df.columns if c != (topic_col or "")]
    value = F.to_json(F.struct(*payload_cols)).alias("value")
    named = F.col(topic_col) if topic_col else F.lit(topic)
    out = df.select(value, named.alias("topic"))
    if df.isStreaming:
        from ..streaming.jobs import start
        options = {"kafka.bootstrap.servers": kafka_servers} if kafka_servers else {}
        return start(df.sparkSession, out, name or f"topic/{topic or topic_col}", sink="kafka" if kafka_servers else fmt,
                     path=None if kafka_servers else target, options=options, trigger=trigger,
                     partition_by=None if kafka_servers else ["topic"])
    if kafka_servers:
        return out.write.format("kafka").option("kafka.bootstrap.servers", kafka_servers).save()
    return out.write.mode("append").partitionBy("topic").format(fmt).save(target)


def write_routed(spark: SparkSession, parts: dict[str, DataFrame], target: str, source: DataFrame | None = None,
                 kafka_servers: str | None = None):
    """K3: write several projections of one parsed input (side outputs) to
    their topics, parsing the input once: ``source`` is persisted for the
    duration of the writes and released afterwards."""
    if source is not None:
        source.persist()
    try:
        for name, part in parts.items():
            topic_sink(part, target, topic=name, kafka_servers=kafka_servers)
    finally:
        if source is not None:
            source.unpersist()


# ---------------------------------------------------------------- K4 OLAP JSON lines
def json_lines(df: DataFrame, snake: bool = True) -> DataFrame:
    """K4: one JSON object per line with snake_case field names (nulls omitted)."""
    d = df.toDF(*[camel_to_snake(c) for c in df.columns]) if snake else df
    return d.select(F.to_json(F.struct(*d.columns)).alias("value"))


def olap_load(df: DataFrame, path: str, name: str = "olap", max_records_per_file: int = 1_000_000, trigger: dict | None = None):
    """K4 loader: JSON lines in files of bounded size; a stream loads batch by batch, each into a
    folder of its own that a repeated batch writes again."""
    def load(lines: DataFrame, to: str) -> None:
        lines.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).text(to)

    lines = json_lines(df)
    if not df.isStreaming:
        return load(lines, path)
    from ..streaming.jobs import start
    return start(df.sparkSession, lines, name, foreach_batch=lambda batch, number: load(batch, f"{path}/batch={number}"), trigger=trigger)


# ---------------------------------------------------------------- K5 upsert
def upsert_merge(current: DataFrame, incoming: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
                 order: Sequence[str | Column] | None = None) -> DataFrame:
    """K5 ``INSERT ... ON DUPLICATE KEY UPDATE update_cols``.

    The incoming batch is reduced to its latest row per key (``order``); a key
    that exists keeps all its columns except ``update_cols``, which take the
    incoming values; a new key is inserted whole; untouched keys stay.
    """
    keys = list(keys)
    inc = keep_last(incoming, keys, order) if order else incoming.dropDuplicates(keys)
    cols = [c for c in current.columns if c not in keys]
    cur = current.select(*keys, *[F.col(c).alias(f"__c_{c}") for c in cols], F.lit(True).alias("__has_cur"))
    new = inc.select(*keys, *[F.col(c).alias(f"__n_{c}") for c in cols], F.lit(True).alias("__has_new"))
    j = cur.join(new, keys, "full_outer")
    out = []
    for c in cols:
        if c in update_cols:
            v = F.when(F.col("__has_new"), F.col(f"__n_{c}")).otherwise(F.col(f"__c_{c}"))
        else:
            v = F.when(F.col("__has_cur"), F.col(f"__c_{c}")).otherwise(F.col(f"__n_{c}"))
        out.append(v.alias(c))
    return j.select(*keys, *out)


def upsert_write(batch: DataFrame, path: str, keys: Sequence[str], update_cols: Sequence[str], order: Sequence[str | Column],
                 part: Column, part_name: str = "part") -> DataFrame:
    """K5 writer for ``foreachBatch``: merge the batch into the Parquet table at ``path``; the table.

    ``part`` names a row's partition and depends on its keys alone (a day, or a bucket of the keys as many
    as the table's bytes ask for), so a key never moves.  Only the partitions that the batch touches are
    read, merged, staged beside the table, and put in place by dynamic partition overwrite; AQE's rebalance
    gives each task about the advisory size, whatever the partitions hold.  Merging a batch again
    changes nothing, so a batch that is replayed after a failure leaves the table as if it had run once.
    """
    if not order:
        raise ValueError("an upsert needs an order of the batch's rows")
    spark, keys = batch.sparkSession, list(keys)
    latest = keep_last(batch, keys, order).withColumn(part_name, part)
    merged = latest
    try:
        current = spark.read.schema(latest.schema).parquet(path)
    except AnalysisException:  # the first batch
        current = None
    if current is not None:
        touched = [r[0] for r in latest.select(part_name).distinct().collect()]  # folders of the table at most
        merged = upsert_merge(current.where(F.col(part_name).isin(touched)), latest, [*keys, part_name], update_cols).select(*latest.columns)
    staged = f"{path.rstrip('/')}-staged"
    merged.hint("rebalance", part_name).write.mode("overwrite").partitionBy(part_name).parquet(staged)
    spark.read.schema(latest.schema).parquet(staged).hint("rebalance", part_name).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(part_name).parquet(path)
    return spark.read.schema(latest.schema).parquet(path)


# ---------------------------------------------------------------- K6 day partitions
def day_partition(df: DataFrame, time_col: str, out: str = "day", tz: str = "UTC") -> DataFrame:
    """K6: ``day = yyyyMMdd`` from a time that is seconds or ms; unparseable or
    missing times go to ``error_bucket``."""
    ms = to_millis(F.col(time_col).try_cast("long"))
    day = F.date_format(ms_to_wall(ms, tz), "yyyyMMdd")
    return df.withColumn(out, F.coalesce(day, F.lit("error_bucket")))


def write_day_partitioned(df: DataFrame, path: str, time_col: str, max_records_per_file: int = 5_000_000,
                          tasks_per_day: int = 8):
    """K6 writer: one folder per day, files rolled by record count; a day is dealt to several tasks.
    A streaming frame is written by its own ``foreachBatch`` with this function."""
    dealt = day_partition(df, time_col).withColumn("__task", F.pmod(F.xxhash64(*df.columns), F.lit(tasks_per_day)))
    (dealt.repartition("day", "__task").drop("__task").write.mode("append")
     .option("maxRecordsPerFile", max_records_per_file).partitionBy("day").parquet(path))


def pack_days(spark: SparkSession, path: str, out: str, target_bytes: int = 128 << 20, day: str = "day") -> DataFrame:
    """K6 rolling by size: a copy of a day-partitioned Parquet table in files of about ``target_bytes``; it.

    The measured bytes of each day's files are laid end to end, the smallest first, and cut at every
    ``target_bytes``: the files that begin in one stretch are one bin, written by one task as one file.
    So a bin is less than ``target_bytes`` and the file that crosses its end, and only a day's last bin may
    be small; larger files stay what they are, a bin of their own.  Files are listed by Spark, not
    opened; rows and partitions are unchanged, and an interrupted copy leaves the table as it was.
    """
    name = lambda c: F.substring_index(c, "/", -2)  # the day's folder and the file
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    files = files.select(name("path").alias("__file"), "length")
    files = files.withColumn("__day", F.substring_index("__file", "/", 1))
    before = Window.partitionBy("__day").orderBy("length", "__file").rowsBetween(Window.unboundedPreceding, -1)
    binned = files.withColumn("__bin", F.floor(F.coalesce(F.sum("length").over(before), F.lit(0)) / target_bytes))
    # A number for each bin that holds a file, over all days: one row a day is summed up in order.
    own = Window.partitionBy("__day").orderBy("__bin")
    binned = binned.withColumn("__place", F.dense_rank().over(own) - 1)
    days = binned.groupBy("__day").agg((F.max("__place") + 1).alias("__bins"))
    upto = Window.orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("__first", F.coalesce(F.sum("__bins").over(upto), F.lit(0)))
    ids = binned.join(days.select("__day", "__first"), "__day").select("__file", (F.col("__first") + F.col("__place")).cast("int").alias("__id"))
    total = days.agg(F.sum("__bins")).first()[0]
    schema = spark.read.parquet(path).schema if total else None
    if schema is None:
        return spark.createDataFrame([], f"{day} string")
    rows = spark.read.schema(schema).parquet(path).select("*", name("_metadata.file_path").alias("__file"))
    placed = rows.join(ids, "__file").drop("__file")
    placed.repartitionById(int(total), "__id").drop("__id").write.mode("overwrite").partitionBy(day).parquet(out)
    return spark.read.schema(schema).parquet(out)


# ---------------------------------------------------------------- K7 / K8 dimension maintenance
def dim_upsert(current: DataFrame | None, changes: DataFrame, key: str, columns: Sequence[str], order: str,
               op_col: str | None = "op") -> DataFrame:
    """K7: deletes and changes without a row key are ignored; per key each column takes its
    latest non-null change, falling back to the current value when no change set it."""
    latest = latest_non_null(changes.where(F.col(key).isNotNull()), [key], order, columns, skip_op=op_col)
    if current is None:
        return latest
    cur = current.select(key, *[F.col(c).alias(f"__c_{c}") for c in columns])
    j = cur.join(latest, key, "full_outer")
    return j.select(key, *[F.coalesce(F.col(c), F.col(f"__c_{c}")).alias(c) for c in columns])


def dim_config_route(unpacked: DataFrame, config: DataFrame, sep: str = "_") -> DataFrame:
    """U4: route changes to dimension tables as a config table says.

    ``config`` has a row per source table: ``source_table``, ``sink_table`` and ``row_key``, the
    comma-separated fields whose values joined by ``sep`` name the row (F8; the key is their
    md5, F7).  Deletes are ignored; every column is written, null as the text "null".  The config
    is one row per table, which the planner measures before it broadcasts it.
    """
    return _dim_rows(unpacked.where("op <> 'd'").join(config, F.col("_table") == F.col("source_table")), unpacked.columns, sep)


def _dim_rows(routed: DataFrame, columns: Sequence[str], sep: str) -> DataFrame:
    """The rows to write for changes beside their ``sink_table`` and ``row_key`` fields."""
    data = F.transform_values("data", lambda k, v: F.coalesce(v, F.lit("null")))
    parts = F.transform(F.split("row_key", ","), lambda f: F.coalesce(F.col("data")[F.trim(f)], F.lit("null")))
    return routed.select(*[c for c in columns if c not in ("_table", "data", "op")], "sink_table",
                         md5_key(F.concat_ws(sep, parts)).alias("row_key"), data.alias("data"))


def config_versions(changes: DataFrame, order: str = "arrival") -> DataFrame:
    """The versions of a config from its change log (``order``, ``op``, ``source_table``, ``sink_table``,
    ``row_key``): (source_table, sink_table, row_key, valid_from, valid_to), valid up to but without
    ``valid_to`` (null: still).  A delete ends a version and begins none; of changes of a table at the
    same time deletes come first and the last by sink table and row key holds.  A log without any
    change of a table has no version of it.
    """
    w = Window.partitionBy("source_table").orderBy(order, (F.col("op") != "d").cast("int"), "sink_table", "row_key")
    spans = changes.where("source_table is not null").select(
        "op", "source_table", "sink_table", "row_key", F.col(order).alias("valid_from"), F.lead(order).over(w).alias("valid_to"))
    return spans.where("op <> 'd' and (valid_to is null or valid_from < valid_to)").drop("op")


def dim_config_route_as_of(unpacked: DataFrame, changes: DataFrame, order: str = "arrival", sep: str = "_") -> DataFrame:
    """U4 with a config that changes: each change is routed as the config version valid at its arrival
    says (a version holds from its own arrival on), so it comes out the same however late it is read.
    Changes of tables without a valid version go nowhere, as do deletes.

    Versions are few and small beside the changes: the planner broadcasts them when it measures them
    so; else the join shuffles by table, and AQE splits the tables that hold most changes.
    """
    versions = config_versions(changes, order)
    own = unpacked.where("op <> 'd'")
    at = F.col(order)
    valid = (at >= F.col("valid_from")) & (F.col("valid_to").isNull() | (at < F.col("valid_to")))
    return _dim_rows(own.join(versions, (F.col("_table") == F.col("source_table")) & valid), unpacked.columns, sep)


def dim_config_route_stream(unpacked: DataFrame, read_changes, path: str, name: str, order: str = "arrival", sep: str = "_",
                            trigger: dict | None = None):
    """The same on a stream of changes: (query, path).  ``read_changes()`` gives the config's change log
    as it stands; it is called again for each micro-batch, so a batch sees every config change that
    came before it.  A batch writes one part of its own under ``path``; a repeated one writes it again,
    and routes alike, as versions are found by arrival and not by the time of reading."""
    from ..streaming.jobs import start

    def write(batch: DataFrame, number: int) -> None:
        dim_config_route_as_of(batch, read_changes(), order, sep).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return start(unpacked.sparkSession, unpacked, name, foreach_batch=write, trigger=trigger), path


def delete_keys(current: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K8: drop the rows whose key is listed (anti join)."""
    return current.join(keys_df.select(*keys).distinct(), list(keys), "left_anti")


# ---------------------------------------------------------------- K9
def console(df: DataFrame, n: int = 20, name: str = "console", trigger: dict | None = None):
    """K9: print rows; a streaming frame starts a console query and returns it."""
    if df.isStreaming:
        from ..streaming.jobs import start
        return start(df.sparkSession, df, name, sink="console", options={"numRows": n, "truncate": "false"}, trigger=trigger)
    df.show(n, truncate=False)
