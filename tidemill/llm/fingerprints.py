"""Document fingerprints: bottom-k sketches of shingle hashes (operator 9), in DataFrame functions only.

A sketch is the sorted array of the ``K`` smallest 64-bit hashes of a text's distinct
five-word shingles (all of them, if fewer; a text under five words is one shingle).  Sketches
of parts merge by keeping the ``K`` smallest of their union; the share of the union's bottom
hashes that both sides hold estimates resemblance, and the largest hash of a full sketch the
number of distinct shingles.  Equal texts have equal sketches.

Edge cases: null text counts as empty; empty texts have the empty sketch, which resembles
only itself (1.0); a text without shingles contains nothing and is contained in all; rows with
null ``doc_id`` come first in the order, rows of one ``doc_id`` follow each other by text; of a
single row the next document is itself; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_GAP

K, SHINGLE = 128, 5
BUCKET_ROWS, MOST_BUCKETS = 1000, 2048
_GAPS = " \t\n\x0b\f\r"


def with_sketch(rows: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """``rows`` with the sketch of a text column; hashes of words are made once and shared."""
    own = rows.columns
    out = rows.withColumn(f"{name}_w", F.split(F.btrim(F.col(text), F.lit(_GAPS)), WORD_GAP))
    out = out.withColumn(f"{name}_h", F.transform(f"{name}_w", lambda w: F.xxhash64(w)))
    h = F.col(f"{name}_h")
    runs = F.transform(F.slice(h, 1, F.size(h) - (SHINGLE - 1)),
                       lambda x, i: F.xxhash64(x, *[F.get(h, i + d) for d in range(1, SHINGLE)]))
    out = out.withColumn(f"{name}_s", F.when(F.size(h) >= SHINGLE, runs)
                         .when(F.get(F.col(f"{name}_w"), F.lit(0)) == "", F.array().cast("array<bigint>"))
                         .otherwise(F.array(F.xxhash64(h))))
    sketch = F.slice(F.sort_array(F.array_distinct(f"{name}_s")), 1, k)
    return out.select(*own, sketch.alias(name))


def merged(a, b, k: int = K) -> F.Column:
    """The sketch of both parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def _shared(union, a, b):
    return F.size(F.array_intersect(F.array_intersect(union, a), b))


def resemblance(a, b, k: int = K) -> F.Column:
    """Estimated share of the distinct shingles of either text that both hold."""
    union = merged(a, b, k)
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(_shared(union, a, b) / F.size(union))


def distinct_shingles(a, k: int = K) -> F.Column:
    """Estimated number of distinct shingles; exact where the sketch is not full."""
    span = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / span)


def containment(a, b, k: int = K) -> F.Column:
    """Estimated share of the shingles of ``a`` that ``b`` holds."""
    union = merged(a, b, k)
    both = _shared(union, a, b) / F.size(union) * distinct_shingles(union, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_shingles(a, k)))


def shown(a) -> F.Column:
    """The sketch as a string: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def _bucket(cuts: list[int]) -> str:
    """SQL for the number of cuts at or under ``doc_id``: a balanced tree of comparisons."""
    def tree(low: int, high: int) -> str:
        if low == high:
            return str(low)
        mid = (low + high) // 2
        return f"CASE WHEN doc_id < {cuts[mid]} THEN {tree(low, mid)} ELSE {tree(mid + 1, high)} END"

    return f"CASE WHEN doc_id IS NULL THEN -1 ELSE {tree(0, len(cuts))} END"


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text, next_sketch, sketch): each document beside the next by ``doc_id``,
    the last beside the first.

    Rows are dealt once, into ranges of ``doc_id`` at approximate quantiles (at most
    ``MOST_BUCKETS`` of them come to the driver).  The first row of each range is added to the
    end of the range before it, so one window within ranges finds every next row.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    n = rows.count()
    number = max(1, min(MOST_BUCKETS, math.ceil(n / BUCKET_ROWS)))
    shares = [i / number for i in range(1, number)]
    cuts: list[int] = []
    if shares and n:
        found = rows.select(F.percentile_approx("doc_id", shares, 20_000).alias("q")).first()["q"] or []
        cuts = sorted(set(found))
    placed = rows.withColumn("bucket", F.expr(_bucket(cuts)))
    heads = sorted((r["bucket"], r["doc_id"]) for r in placed.groupBy("bucket").agg(F.min("doc_id").alias("doc_id")).collect()
                   if r["bucket"] >= 0)
    empty = placed.where("bucket = -1").limit(1).count()
    heads = ([(-1, None)] if empty else []) + heads
    before = [(d, heads[i - 1][0]) for i, (_, d) in enumerate(heads)]
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame(before, "head_id long, before int"))
    first = (rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["head_id"]))
             .groupBy("head_id", "before").agg(F.min("text").alias("text")))
    added = first.select(F.col("head_id").alias("doc_id"), "text", F.col("before").alias("bucket"), F.lit(True).alias("added"))
    dealt = placed.withColumn("added", F.lit(False)).unionByName(added).repartition("bucket")
    dealt = with_sketch(dealt, "text", "sketch")
    order = Window.partitionBy("bucket").orderBy("added", "doc_id", "text")
    out = dealt.withColumn("next_text", F.lead("text").over(order)).withColumn("next_sketch", F.lead("sketch").over(order))
    return out.where("not added").drop("added", "bucket")


def report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text whose last half the next document's beginning replaces."""
    out = with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    out = out.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
                                            F.substring("next_text", F.lit(1), half)))
    out = with_sketch(out.drop("text", "next_text"), "edited", "edited_sketch")
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      shown(F.col("sketch")).alias("fingerprint"), shown(F.col("edited_sketch")).alias("edited_fingerprint"),
                      resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                      resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
                      distinct_shingles(F.col("sketch")).alias("distinct_shingles"))
