"""Keyword table function.

The DataFrame jobs split text with JVM built-ins (``explode(split(lower(t),
...))``), which stays inside whole-stage codegen.  For SQL users who write
``LATERAL kw(text)`` as the reference's SQL job does, :func:`register_keyword_udtf`
registers a Python table function with the same tokenisation (Arrow-batched).
"""

from __future__ import annotations

import regex
from pyspark.sql import SparkSession

__all__ = ["register_keyword_udtf"]

_WORD = regex.compile(r"[\p{L}\p{N}]+")


def register_keyword_udtf(spark: SparkSession, name: str = "keyword_udtf"):
    """Register ``name(text) -> TABLE(word STRING)`` for ``LATERAL`` use in SQL."""
    from pyspark.sql.functions import udtf

    from ..session import ship_package

    ship_package(spark)

    @udtf(returnType="word string", useArrow=True)
    class KeywordUDTF:
        def eval(self, text: str):
            if text is None:
                return
            for m in _WORD.finditer(text.lower()):
                yield (m.group(0),)

    spark.udtf.register(name, KeywordUDTF)
    return KeywordUDTF
