"""Key, hash and naming helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

__all__ = ["md5_key", "composite_key", "hash_bucket", "snake_to_camel", "camel_to_snake",
           "rename_columns", "prefix_columns"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def md5_key(col) -> Column:
    """hex md5 of the key's string form (row key of a dimension row)."""
    return F.md5(_c(col).cast("string"))


def composite_key(cols, sep: str = "_", md5_items: bool = False, md5_whole: bool = False) -> Column:
    """F8: join key parts with ``sep``; optionally md5 each part and/or the result."""
    parts = [md5_key(c) if md5_items else _c(c).cast("string") for c in cols]
    k = F.concat_ws(sep, *parts)
    return F.md5(k) if md5_whole else k


def hash_bucket(col, n_buckets: int, hot_keys: dict[str, int] | None = None, width: int = 4) -> Column:
    """bucket = (last 3 hex digits of md5) mod n, left-padded to ``width``.

    ``hot_keys`` maps a lower-cased key to a reserved bucket number (the skew
    override).  Used to salt/assign buckets for hot keys before aggregation.
    """
    tail = F.conv(F.substring(F.md5(_c(col).cast("string")), -3, 3), 16, 10).cast("int")
    b = F.pmod(tail, F.lit(n_buckets))
    if hot_keys:
        m = F.create_map(*[x for k, v in hot_keys.items() for x in (F.lit(k.lower()), F.lit(int(v)))])
        b = F.coalesce(m[F.lower(_c(col).cast("string"))], b)
    return F.lpad(b.cast("string"), width, "0")


def snake_to_camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(p[:1].upper() + p[1:] for p in rest)


def camel_to_snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


def rename_columns(df: DataFrame, to: str = "camel") -> DataFrame:
    """F16: rename all columns snake <-> camel (metadata only, no data movement)."""
    f = snake_to_camel if to == "camel" else camel_to_snake
    return df.toDF(*[f(c) for c in df.columns])


def prefix_columns(df: DataFrame, prefix: str = "info_", keep: tuple[str, ...] = ()) -> DataFrame:
    """prefix every column (except ``keep``) of the right side of a join."""
    return df.select(*[F.col(c).alias(c if c in keep else prefix + c) for c in df.columns])
