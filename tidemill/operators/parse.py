"""Parse, split and route.

Side outputs of the reference become several projections of one DataFrame.  When
they are all written, :func:`tidemill.sinks.write_routed` persists the parsed
input once and writes each projection, so the JSON is parsed a single time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

__all__ = ["APP_LOG_SCHEMA", "CDC_SCHEMA", "drop_null_payload", "split_dirty", "split_log",
           "unpack_cdc", "route_by_table", "ODS_TABLES"]

# App log record (pipeline R).  Inner fields of start/err/displays/actions are
# never read by any job, so they are kept generic.
APP_LOG_SCHEMA = (
    "common struct<mid:string,uid:string,vc:string,ch:string,ar:string,is_new:string>,"
    "page struct<page_id:string,last_page_id:string,item:string,item_type:string,during_time:long>,"
    "start map<string,string>, err map<string,string>,"
    "displays array<map<string,string>>, actions array<map<string,string>>, ts long")

# Change envelope (pipeline G); row images are string maps as in the JSON.  (DDL text:
# usable by from_json / readStream.schema without a live session.)
CDC_SCHEMA = (
    "op string, before map<string,string>, after map<string,string>,"
    "source struct<db:string,table:string,ts_ms:long>, ts_ms long")

# The six source tables of the traffic pipeline.
ODS_TABLES = [
    "ods_user_visit_log",
    "ods_product_interaction_log",
    "ods_order_pay_log",
    "ods_search_log",
    "ods_page_click_log",
    "ods_crowd_attribute_log",
]


def drop_null_payload(df: DataFrame, value: str = "value") -> DataFrame:
    """A null payload becomes a null record and is filtered downstream."""
    return df.where(F.col(value).isNotNull())


def split_dirty(raw: DataFrame, schema: StructType | str = APP_LOG_SCHEMA, value: str = "value",
                keep: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Records whose payload is not a JSON object go to ``dirty`` verbatim;
    the rest are parsed with ``schema`` into ``clean`` (its fields + ``keep``).

    One parse serves both: the scalar fields are read as strings (as the
    reference's coercing getters take them) and cast afterwards, so a record is
    dirty only if its text is malformed, and numbers in quotes count as numbers.
    """
    v = F.col(value)
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    loose = StructType([*[StructField(f.name, _loose(f.dataType)) for f in wanted.fields], StructField(_BAD, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD, "maxStringLen": str(2**31 - 1)}
    tagged = raw.withColumn("__r", F.from_json(v, loose, options))
    ok = F.coalesce(F.col(f"__r.{_BAD}").isNull() & F.col("__r").isNotNull() & v.rlike(r"^[ \t\r\n]*\{"), F.lit(False))
    tagged = tagged.withColumn("__ok", ok)
    dirty = tagged.where(~F.col("__ok")).select(*keep, value)
    clean = tagged.where(F.col("__ok")).select(
        *keep, *[_strict(F.col(f"__r.{f.name}"), f.dataType).alias(f.name) for f in wanted.fields])
    return {"dirty": dirty, "clean": clean}


_BAD = "__corrupt"


def _loose(kind: DataType) -> DataType:
    """The same shape with every scalar as a string."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _loose(f.dataType)) for f in kind.fields])
    if isinstance(kind, (ArrayType, MapType)):
        return kind
    return StringType()


def _strict(col: Column, kind: DataType) -> Column:
    """Cast the strings of a loosely parsed column; what is no such value becomes null."""
    if isinstance(kind, StructType):
        if _loose(kind) == kind:
            return col
        return F.when(col.isNotNull(), F.struct(*[_strict(col[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, (ArrayType, MapType, StringType)):
        return col
    return F.trim(col).try_cast(kind)


def split_log(log: DataFrame, keep: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The log splitter.

    * ``err``: the err object of every record that has one;
    * ``start``: records with a start object, whole (minus err);
    * ``display``: one row per element of a non-empty ``displays`` (common, page, display, ts);
    * ``action``: one row per element of a non-empty ``actions`` (common, page, action; no ts);
    * ``page``: every non-start record minus err and minus non-empty displays/actions.
    """
    k = [F.col(c) for c in keep]
    no_start = log.where(F.col("start").isNull())
    nonempty = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    rest = [c for c in log.columns if c not in ("err",) and c not in keep]
    return {
        "err": log.where(F.col("err").isNotNull()).select(*k, "err"),
        "start": log.where(F.col("start").isNotNull()).select(*k, *rest),
        "display": no_start.where(nonempty("displays")).select(
            *k, "common", "page", F.explode("displays").alias("display"), "ts"),
        "action": no_start.where(nonempty("actions")).select(
            *k, "common", "page", F.explode("actions").alias("action")),
        "page": no_start.select(
            *k, *[F.when(nonempty(c), F.lit(None)).otherwise(F.col(c)).alias(c)
                  if c in ("displays", "actions") else F.col(c) for c in rest]),
    }


def unpack_cdc(env: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Row image by op (r/c/u -> after, d -> before, anything else dropped),
    plus the source table name and the op."""
    op = F.col("op")
    data = F.when(op.isin("r", "c", "u"), F.col("after")).when(op == "d", F.col("before"))
    return (env.where(op.isin("r", "c", "u", "d"))
            .select(*keep, op.alias("op"), F.col("source.table").alias("_table"), data.alias("data")))


def route_by_table(df: DataFrame, routes: dict[str, str] | None = None, table: str = "_table",
                   topic_prefix: str = "") -> DataFrame:
    """Add a ``topic`` column from the table name and drop the helper column;
    rows of unknown tables are dropped.  A topic sink writes each row to its topic."""
    routes = routes or {t: topic_prefix + t for t in ODS_TABLES}
    m = F.create_map(*[x for a, b in routes.items() for x in (F.lit(a), F.lit(b))])
    return df.withColumn("topic", m[F.col(table)]).where(F.col("topic").isNotNull()).drop(table)
