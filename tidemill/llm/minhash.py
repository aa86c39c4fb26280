"""MinHash near-duplicate detection with odd sketches (operator 6).

1. Every whole text becomes its set of distinct five-word shingle hashes, MinHash samples of
   it, band keys over the samples, and an odd sketch: each sample toggles one bit of a bitmap,
   so the population count of the XOR of two bitmaps estimates how many samples differ.
2. Documents with equal sets are one class, represented by their smallest ``doc_id``; only
   representatives go on, so groups of exact copies cost one row.
3. Representatives that share a band key are compared by odd sketch.  A bucket of more than
   ``BLOCK`` members is dealt out as pairs of blocks; each task returns a spanning forest of
   what it found (at most one edge a row), never all pairs.
4. The components of these edges hold every candidate link.  Within each, the full sets are
   compared, again block by block, and only links confirmed on the full sets count.
5. The components of the confirmed links are the classes.

The odd sketch only refuses pairs whose estimate lies ``SLACK`` (more than four standard
deviations of the samples) under the threshold.  At similarity 0.8, 28 bands of 5 samples
miss a pair with probability 1.5e-5, at 0.85 with 7e-8; there is no cap on buckets,
candidates or partners.

Edge cases: null and empty texts (and texts of white space) have no shingles and are linked
with nothing; texts under five words are one shingle; repeated rows of a ``doc_id`` count as
one document (of differing texts, the one with the smallest set digest stands for it); a null
``doc_id`` cannot name a class, so such rows are kept with a null ``component_id``; an empty
table gives an empty result; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, on_executors, packed
from .components import components
from .hashing import mix, shingle_hashes, text_ranges, text_words

SHINGLE, BANDS, ROWS, BITS, BLOCK, SLACK = 5, 28, 5, 1024, 256, 0.16
BLOCK_SHINGLES = 1000  # a block holds at most about BLOCK * BLOCK_SHINGLES shingles, or BLOCK texts
_SIGNATURE = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sketch binary"
_rng = np.random.Generator(np.random.PCG64(7))
_MULTIPLY = (_rng.integers(1, 2**32, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)


def text_sets(texts: list) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashed, at = text_words(texts)
    return [np.unique(shingle_hashes(hashed[at[i]:at[i + 1]], SHINGLE)) for i in range(len(texts))]


def digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, whatever the order of its members."""
    one = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    two = np.bitwise_xor.reduce(mix(s + np.uint64(0x14057B7EF767814F))) if len(s) else np.uint64(0)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def samples(s: np.ndarray) -> np.ndarray:
    """MinHash samples of a non-empty set."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(_ADD), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 1024):
        low = np.minimum(low, (_MULTIPLY[:, None] * x[None, k:k + 1024] + _ADD[:, None]).min(axis=1))
    return low


def odd_sketches(m: np.ndarray) -> np.ndarray:
    """Parity bitmaps (rows x BITS/8 bytes) of rows of samples."""
    place = (mix(m.astype(np.uint64) + (np.arange(m.shape[1], dtype=np.uint64) << np.uint64(32)))
             % np.uint64(BITS)).astype(np.int64)
    flat = (np.arange(len(m))[:, None] * BITS + place).ravel()
    return np.packbits((np.bincount(flat, minlength=len(m) * BITS) & 1).reshape(len(m), BITS).astype(np.uint8), axis=1)


def most_odd(least: float, k: int = BANDS * ROWS) -> float:
    """The expected XOR population count at similarity ``least``: pairs above it are refused."""
    return BITS * (1 - (1 - 2 / BITS) ** (2 * k * (1 - least))) / 2


def estimate(odd: int, k: int = BANDS * ROWS) -> float:
    """Similarity that an XOR population count stands for."""
    share = min(2 * odd / BITS, 1 - 1e-9)
    return 1 - math.log(1 - share) / math.log(1 - 2 / BITS) / (2 * k)


def _signatures(rows):
    for batch in rows:
        ids = batch.column(0)
        for first, last, texts in text_ranges(batch.column(1)):
            sets = text_sets(texts)
            full = [i for i, s in enumerate(sets) if len(s)]
            m = np.array([samples(sets[i]) for i in full], np.uint32).reshape(len(full), BANDS * ROWS)
            sketches = dict(zip(full, odd_sketches(m))) if full else {}
            keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64)[None, :], (len(full), BANDS))
            for r in range(ROWS):
                keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + m.reshape(len(full), BANDS, ROWS)[:, :, r])
            bands = dict(zip(full, keys.view(np.int64) if len(full) else []))
            names = [digest(s) for s in sets]
            none = np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                ids.slice(first, last - first).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([x for x, _ in names], pa.int64()), pa.array([x for _, x in names], pa.int64()),
                pa.array([bands.get(i, none) for i in range(len(sets))], pa.list_(pa.int64())),
                pa.array([sketches[i].tobytes() if i in sketches else b"" for i in range(len(sets))], pa.binary()),
            ], names=["doc_id", "n_shingles", "d1", "d2", "bands", "sketch"])


def _in_blocks(rows: DataFrame, group: str, member: str) -> DataFrame:
    """Deal the members of each group of ``n`` rows out as pairs of blocks (i <= j)."""
    count = F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK)).cast("int")
    dealt = (rows.withColumn("blocks", count)
             .withColumn("side", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other"))
             .drop("blocks", "other", "n"))
    return dealt.repartition(group, "i", "j").sortWithinPartitions(group, "i", "j", member)


def _whole_groups(rows, keys: int):
    """Arrow batches again, each ending at the end of a group of rows equal in the first columns."""
    held = None
    for batch in rows:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        k = np.stack([held.column(c).to_numpy() for c in range(keys)])
        change = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0))
        if len(change):
            last = int(change[-1]) + 1
            yield held.slice(0, last)
            held = held.slice(last)
    if held is not None and held.num_rows:
        yield held


class _Forest:
    """Union-find over the rows at hand; keeps the edges that joined two trees."""

    def __init__(self, n: int):
        self.up = np.arange(n)
        self.a: list[int] = []
        self.b: list[int] = []

    def roots(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if np.array_equal(up, self.up):
                return up
            self.up = up

    def _root(self, x: int) -> int:
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        roots = self.roots()
        apart = roots[a] != roots[b]
        for x, y in zip(a[apart].tolist(), b[apart].tolist()):
            p, q = self._root(x), self._root(y)
            if p != q:
                self.up[max(p, q)] = min(p, q)
                self.a.append(x)
                self.b.append(y)

    def edges(self, names: np.ndarray) -> pa.RecordBatch:
        a, b = names[np.array(self.a, int)], names[np.array(self.b, int)]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _sketch_forest(least: float):
    most = most_odd(least - SLACK)

    def run(rows):
        for t in _whole_groups(rows, 3):
            key, i, j, side, rep, n = (t.column(c).to_numpy() for c in range(6))
            bits = np.frombuffer(b"".join(t.column(6).to_pylist()), np.uint64).reshape(len(rep), BITS // 64)
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
            group = np.cumsum(new)
            size = np.bincount(group)
            forest = _Forest(len(rep))
            at = np.arange(len(rep))
            for d in range(1, int(size.max())):
                a = at[:-d][group[:-d] == group[d:]] if d else at
                b = a + d
                fit = ((i[a] == j[a]) | (side[a] != side[b])) & (rep[a] != rep[b])
                fit &= np.minimum(n[a], n[b]) >= least * np.maximum(n[a], n[b])
                a, b = a[fit], b[fit]
                odd = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1)
                forest.join(a[odd <= most], b[odd <= most])
            yield forest.edges(rep)

    return run


def _exact_forest(percent: int):
    def run(rows):
        for t in _whole_groups(rows, 3):
            key, i, j, side, rep = (t.column(c).to_numpy() for c in range(5))
            sets = [np.frombuffer(x, np.uint64) for x in t.column(5).to_pylist()]
            n = np.array([len(s) for s in sets])
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            forest = _Forest(len(rep))
            for low, high in zip([0, *cuts], [*cuts, len(rep)]):
                if high - low < 2:
                    continue
                known, flat = np.unique(np.concatenate(sets[low:high]), return_inverse=True)
                start = np.concatenate(([0], np.cumsum(n[low:high])[:-1]))
                mark = np.zeros(len(known), np.int32)
                for u in range(low, high - 1):
                    roots = forest.roots()
                    v = np.arange(u + 1, high)
                    v = v[(roots[v] != roots[u]) & ((i[low] == j[low]) | (side[v] != side[u]))
                          & (100 * np.minimum(n[v], n[u]) >= percent * np.maximum(n[v], n[u]))]
                    if not len(v):
                        continue
                    own = flat[start[u - low]:start[u - low] + n[u]]
                    mark[own] = 1
                    if len(v) > 8:
                        both = np.add.reduceat(mark[flat], start)[v - low]
                    else:
                        both = np.array([mark[flat[start[x - low]:start[x - low] + n[x]]].sum() for x in v])
                    mark[own] = 0
                    linked = v[100 * both >= percent * (n[v] + n[u] - both)]
                    forest.join(np.full(len(linked), u), linked)
            yield forest.edges(rep)

    return run


def _sets(rows):
    """Full sets of the documents that the wanted digest names."""
    for batch in rows:
        d1, d2 = batch.column(4).to_numpy(), batch.column(5).to_numpy()
        for first, last, texts in text_ranges(batch.column(1)):
            sets = text_sets(texts)
            keep = [k for k, s in enumerate(sets) if digest(s) == (d1[first + k], d2[first + k])]
            part = batch.slice(first, last - first).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [part.column(2), part.column(0).cast(pa.int64()), part.column(3),
                 pa.array([sets[k].tobytes() for k in keep], pa.binary())], names=["label", "rep", "n", "shingles"])


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per document.

    Documents whose shingle sets meet ``100 * |intersection| >= percent * |union|`` are
    linked; ``component_id`` is the smallest ``doc_id`` reachable and ``kept`` marks it.
    """
    on_executors(docs.sparkSession)
    least = percent / 100
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = cut(texts.where("doc_id is not null").mapInArrow(_signatures, _SIGNATURE), "signatures")
    ids = signed.groupBy("doc_id").agg(F.min(F.struct("d1", "d2", "n_shingles")).alias("s")).select("doc_id", "s.*")
    named = ids.where("n_shingles > 0")
    classes = cut(named.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")), "classes")
    reps = classes.select(F.col("rep").alias("doc_id"), "d1", "d2")
    first = signed.join(reps, ["doc_id", "d1", "d2"], "left_semi")
    keys = first.select(F.explode("bands").alias("key"), F.col("doc_id").alias("rep"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    sketched = first.select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("size"), "sketch")
    bucket = _in_blocks(keys.join(shared, "key").join(sketched, "rep"), "key", "rep")
    likely = components(bucket.select("key", "i", "j", "side", "rep", "size", "sketch")
                        .mapInArrow(_sketch_forest(least), "a long, b long"))
    likely = cut(likely.select(F.col("node").alias("rep"), "label"), "likely")
    weight = F.greatest(F.count("*"), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES))  # groups of long texts get smaller blocks
    sizes = likely.join(ids, likely["rep"] == ids["doc_id"]).groupBy("label").agg(weight.alias("n"))
    wanted = likely.join(sizes, "label").join(reps.withColumnRenamed("doc_id", "rep"), "rep")
    wanted = wanted.withColumnRenamed("rep", "doc_id")
    sets = (texts.join(wanted, "doc_id").select("doc_id", "text", "label", "n", "d1", "d2")
            .mapInArrow(_sets, "label long, rep long, n long, shingles binary"))
    links = (_in_blocks(sets, "label", "rep").select("label", "i", "j", "side", "rep", "shingles")
             .mapInArrow(_exact_forest(percent), "a long, b long"))
    joined = components(links).select(F.col("node").alias("rep"), F.col("label").alias("class"))
    member = named.join(classes, ["d1", "d2"]).join(joined, "rep", "left")
    member = member.select("doc_id", F.coalesce("class", "rep").alias("component_id"))
    return (ids.join(member, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each class: its smallest ``doc_id``; all columns stay.

    Of repeated rows of a kept ``doc_id`` one stays; rows without ``doc_id`` stay.
    """
    kept = near_duplicates(docs, percent).where("kept").select(F.col("doc_id").alias("id"))
    rows = packed(docs, F.col("doc_id").cast("long").alias("id"))
    one = rows.where("id is not null").join(kept, "id", "left_semi").dropDuplicates(["id"])
    return one.select("row.*").unionByName(rows.where("id is null").select("row.*"))
