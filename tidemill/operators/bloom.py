"""First record per key through a Bloom filter with an expected number of keys and a rate of
false positives, and an exact check of what the filter cannot tell.

The filter is cut into blocks of 32,768 bits; a key's block comes from one hash and its ``k`` places in
it from two others (double hashing), so a probe reads one block.  A block is a bitmap that Spark
builds with ``bitmap_construct_agg``, and the whole filter is a DataFrame of blocks: built by a
distributed aggregate, merged with others by ``bitmap_or_agg``, never in one place.  Its size follows
from ``n`` and ``fpp`` alone.

A key whose places are not all set was never seen: no new record is lost.  The others are doubtful
and only they meet the exact check, so the seen records are not shuffled for keys that are new.

The streaming form keeps each bucket's filter as bytes in keyed state.  Null is a key value like
others; records are distinct rows of their frame, so repeated rows are repeated keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..session import ship_package
from .dedup import dedup_on_keys
from .keyed import _null_safe_join

__all__ = ["BLOCK_BITS", "filter_size", "bloom_build", "bloom_merge", "bloom_probe", "bloom_dedup", "BloomGate", "bloom_stream",
           "settle_doubtful"]

#: Bits of one block: what the bitmap functions hold in one bitmap.
BLOCK_BITS = 32_768


def filter_size(n: int, fpp: float) -> tuple[int, int]:
    """(bits, places per key) for ``n`` expected keys at a rate ``fpp`` of false positives."""
    bits = max(1, math.ceil(-n * math.log(fpp) / math.log(2) ** 2))
    return bits, max(1, round(bits / max(1, n) * math.log(2)))


def _hashes(keys: Sequence[str]) -> tuple[Column, Column]:
    """Two hashes of the keys; a null leaves a hash as it is, so whether a key is null goes in as well."""
    parts = [x for k in keys for x in (F.col(k).isNull(), F.col(k))]
    return F.xxhash64(*parts), F.xxhash64(F.lit(97), *parts)


def _block(keys: Sequence[str], n: int, fpp: float) -> Column:
    blocks = -(-filter_size(n, fpp)[0] // BLOCK_BITS)
    return F.pmod(_hashes(keys)[0], F.lit(blocks)).cast("int")


def _places(keys: Sequence[str], n: int, fpp: float) -> Column:
    first, second = (F.pmod(F.shiftrightunsigned(h, 20), F.lit(BLOCK_BITS)).cast("int") for h in _hashes(keys))
    step = second.bitwiseOR(F.lit(1))  # odd, so that all places of a block can come up
    return F.array(*[F.pmod(first + F.lit(i) * step, F.lit(BLOCK_BITS)) for i in range(filter_size(n, fpp)[1])])


def bloom_build(df: DataFrame, keys: Sequence[str], n: int, fpp: float) -> DataFrame:
    """(block, bitmap): the filter of the keys of ``df``; blocks without keys have no row."""
    places = df.select(_block(keys, n, fpp).alias("block"), F.explode(_places(keys, n, fpp)).alias("place"))
    return places.groupBy("block").agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bitmap"))


def bloom_merge(*filters: DataFrame) -> DataFrame:
    """The filter of all keys of filters made with the same ``n`` and ``fpp``."""
    both = filters[0]
    for f in filters[1:]:
        both = both.unionByName(f)
    return both.groupBy("block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def _as_longs(bitmap: Column) -> Column:
    """A bitmap as longs of eight bytes, the first byte the highest."""
    whole = F.hex(bitmap)
    return F.transform(F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1)),
                       lambda i: F.conv(F.substr(whole, i * 16 + 1, F.lit(16)), 16, -10).cast("long"))


def bloom_probe(df: DataFrame, keys: Sequence[str], seen: DataFrame, n: int, fpp: float, out: str = "maybe_seen") -> DataFrame:
    """``df`` with ``out``: whether the filter holds the row's key, or seems to."""
    blocks = seen.select(F.col("block").alias("__block"), _as_longs(F.col("bitmap")).alias("__longs"))
    rows = df.withColumns({"__own": _block(keys, n, fpp), "__places": _places(keys, n, fpp)})
    joined = rows.join(blocks, F.col("__own") == F.col("__block"), "left")

    def is_set(p: Column) -> Column:  # bit p % 8 of byte p / 8, as the bitmap functions number them
        inside = p % 64
        at = (F.lit(7) - F.floor(inside / 8)).cast("int") * 8 + inside % 8
        return F.getbit(F.get("__longs", F.floor(p / 64).cast("int")), at) == 1

    return joined.select(*[F.col(f"`{c}`") for c in df.columns],
                         F.coalesce(F.forall("__places", is_set) & F.col("__longs").isNotNull(), F.lit(False)).alias(out))


def bloom_dedup(new: DataFrame, seen: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int, fpp: float = 0.01) -> DataFrame:
    """The first row per key of ``new``, in ``order``, of the keys that ``seen`` doesn't hold.

    Exact whatever ``n``: with more keys than expected, more rows are doubtful.
    """
    probed = bloom_probe(dedup_on_keys(new, keys, order), keys, bloom_build(seen, keys, n, fpp), n, fpp, "__maybe")
    sure, doubtful = probed.where(~F.col("__maybe")).drop("__maybe"), probed.where("__maybe").drop("__maybe")
    # Of the seen records only those of doubtful keys go on; their keys then settle the doubt.
    wanted = doubtful.select(*keys)
    hits = seen.select(*keys).join(wanted.select(*[F.col(k).alias(f"__w_{k}") for k in keys]),
                                   [F.col(k).eqNullSafe(F.col(f"__w_{k}")) for k in keys], "left_semi").distinct()
    return sure.unionByName(_null_safe_join(doubtful, hits, list(keys), "left_anti"))


# ---------------------------------------------------------------- stream
class BloomGate(StatefulProcessor):
    """A bucket's filter as bytes; emits its rows with ``doubtful``: the key was seen, or seems so."""

    def __init__(self, columns: Sequence[str], order: str, n: int, fpp: float):
        self.columns, self.order = list(columns), order
        self.bits, self.k = filter_size(n, fpp)

    def init(self, handle) -> None:
        self._filter = handle.getValueState("filter", "bits binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802,N803
        state = self._filter.get()
        bits = np.zeros(-(-self.bits // 8), np.uint8) if state is None else np.frombuffer(bytes(state[0]), np.uint8).copy()
        # What a bucket gets in a micro-batch is bounded by the source; its pieces come in no order.
        df = pd.concat(list(rows), ignore_index=True).sort_values(self.order, kind="stable")
        first, step = (df[c].to_numpy(np.int64).view(np.uint64) for c in ("bloom_a", "bloom_b"))
        with np.errstate(over="ignore"):
            places = (first[:, None] + np.arange(self.k, dtype=np.uint64) * (step | np.uint64(1))[:, None]) % np.uint64(self.bits)
        byte, mask = (places >> np.uint64(3)).astype(np.int64), np.left_shift(1, (places & np.uint64(7)).astype(np.uint8)).astype(np.uint8)
        held = ((bits[byte] & mask) != 0).all(1)
        again = df.duplicated(["bloom_a", "bloom_b"]).to_numpy()  # earlier in this batch
        np.bitwise_or.at(bits, byte.ravel(), mask.ravel())
        self._filter.update((bits.tobytes(),))
        yield df[self.columns].assign(doubtful=held | again)

    def close(self) -> None:
        pass


def bloom_stream(stream: DataFrame, keys: Sequence[str], order: str, n: int, fpp: float = 0.01, buckets: int = 64) -> DataFrame:
    """The rows of a stream with ``doubtful``; rows of new keys that aren't doubtful are the first of their key."""
    ship_package(stream.sparkSession)
    a, b = _hashes(keys)
    dealt = stream.select(*stream.columns, a.alias("bloom_a"), b.alias("bloom_b"),
                          F.pmod(F.xxhash64(b, F.lit(31)), F.lit(buckets)).cast("int").alias("bloom_bucket"))
    schema = ", ".join(f"`{c}` {stream.schema[c].dataType.simpleString()}" for c in stream.columns) + ", doubtful boolean"
    gate = BloomGate(stream.columns, order, -(-n // buckets), fpp)
    return dealt.groupBy("bloom_bucket").transformWithStateInPandas(gate, schema, "append", "None")


def settle_doubtful(gated: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The exact check of a gated topic at rest: all sure rows, and the first of each doubtful key that
    no sure row has."""
    sure, doubtful = gated.where("not doubtful").drop("doubtful"), gated.where("doubtful").drop("doubtful")
    firsts = dedup_on_keys(doubtful, keys, order)
    return sure.unionByName(_null_safe_join(firsts, sure.select(*keys), list(keys), "left_anti"))
