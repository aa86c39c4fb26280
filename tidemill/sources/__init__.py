"""Sources (S1–S12).

Topic sources read Kafka when brokers are given, otherwise a directory stands
for the topic (tests, replays).  Table sources are plain Spark readers, so
Catalyst pushes filters and column pruning into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.keys import rename_columns
from ..operators.parse import drop_null_payload

__all__ = ["read_topic", "topic_table", "read_jdbc", "read_json_lines", "scan_limit", "point_lookup",
           "row_count", "register_table", "read_word_list"]


def read_topic(spark: SparkSession, topic: str, *, kafka_servers: str | None = None, path: str | None = None,
               starting_offsets: str = "earliest", schema: str = "arrival long, value string",
               fmt: str = "parquet", stream: bool = True, files_per_trigger: int | None = None,
               null_safe: bool = True, offsets_per_trigger: int | None = None) -> DataFrame:
    """A topic as ``(arrival, value)``.  An offset is unique only inside a
    partition, so a Kafka record's ``arrival`` is a sortable string of timestamp,
    partition and offset; a directory topic stores its own arrival column.  Null payloads
    are dropped when ``null_safe`` (S2); ``files_per_trigger`` and ``offsets_per_trigger``
    bound a micro-batch."""
    if kafka_servers:
        r = spark.readStream if stream else spark.read
        df = (r.format("kafka").option("kafka.bootstrap.servers", kafka_servers).option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
        if stream and offsets_per_trigger:
            df = df.option("maxOffsetsPerTrigger", offsets_per_trigger)
        df = kafka_records(df.load())
    else:
        base = f"{path.rstrip('/')}/topic={topic}" if path else topic
        if stream:
            r = spark.readStream.schema(schema).format(fmt)
            if files_per_trigger:
                r = r.option("maxFilesPerTrigger", files_per_trigger)
            df = r.load(base)
        else:
            df = spark.read.schema(schema).format(fmt).load(base)
    return drop_null_payload(df) if null_safe else df


def kafka_records(raw: DataFrame) -> DataFrame:
    """``(arrival, value)`` of Kafka rows; arrivals order records over all partitions: 20 digits
    of microseconds, 10 of the partition, 20 of the offset."""
    digits = lambda c, n: F.lpad(c.cast("string"), n, "0")
    arrival = F.concat(digits(F.unix_micros("timestamp"), 20), digits(F.col("partition"), 10), digits(F.col("offset"), 20))
    return raw.select(arrival.alias("arrival"), F.col("value").cast("string").alias("value"))


def topic_table(raw: DataFrame, ddl: str, view: str | None = None, ms_field: str = "ts",
                et: str = "et", lateness: str | None = "5 seconds", wall_clock: bool = False) -> DataFrame:
    """A SQL-declared topic table — ``from_json`` with a DDL schema, a
    computed event-time column (TO_TIMESTAMP_LTZ of ms, or with ``wall_clock``
    the UTC wall clock as TIMESTAMP_NTZ, independent of the session zone) and a
    watermark; registered as a temp view for ``spark.sql``."""
    from ..functions.time import ms_to_wall

    df = raw.select(F.from_json("value", ddl).alias("r")).select("r.*")
    df = df.withColumn(et, ms_to_wall(ms_field) if wall_clock else F.timestamp_millis(F.col(ms_field)))
    if lateness and df.isStreaming:
        df = df.withWatermark(et, lateness)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_jdbc(spark: SparkSession, url: str, query: str, camel: bool = False, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """A JDBC query as a DataFrame (column labels kept); ``camel`` renames
    snake_case columns to camelCase (F16).  Give a partition column and bounds
    to read in parallel."""
    r = spark.read.format("jdbc").option("url", url)
    if not partition_column:
        r = r.option("query", query)
    else:
        r = r.option("dbtable", f"({query}) q")  # bounds go with a table expression, not with a query
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    df = r.load()
    return rename_columns(df, "camel") if camel else df


def read_json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A JSON-lines file scan (give ``schema`` to skip inference)."""
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.json(path)


def scan_limit(df: DataFrame, n: int, key: str | None = None, key_alias: str = "row_key") -> DataFrame:
    """The first ``n`` rows of a keyed table with its key as a column."""
    out = df.withColumnRenamed(key, key_alias) if key else df
    return out.limit(n)


def point_lookup(df: DataFrame, key_col: str, key) -> DataFrame:
    """Rows of one key (a pushed-down equality filter on the scan)."""
    return df.where(F.col(key_col) == F.lit(key))


def row_count(df: DataFrame) -> DataFrame:
    """The table's row count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def register_table(spark: SparkSession, name: str, df: DataFrame | None = None, ddl: str | None = None,
                   path: str | None = None, replace: bool = True) -> DataFrame:
    """Catalog DDL — drop-if-exists, then create a parquet table (from a
    DataFrame, or empty from a DDL column list) and return it."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    if df is not None:
        w = df.write.format("parquet").mode("overwrite")
        if path:
            w = w.option("path", path)
        w.saveAsTable(name)
    elif ddl:
        loc = f" LOCATION '{path}'" if path else ""
        spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet{loc}")
    return spark.table(name)


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line -> ``word`` (trimmed, blanks dropped, distinct)."""
    return (spark.read.text(path).select(F.trim("value").alias("word"))
            .where(F.col("word") != "").distinct())
