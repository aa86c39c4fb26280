"""Whitening of embeddings through pivoted Cholesky and one-sided Jacobi (operator 12).

Entries are put on a grid of whole numbers, so that counts and sums are exact.  The scatter is
added up over centred rows, a matrix for each task and piece of a task, and the sums of these go
to the driver: ``dim * dim`` numbers, whatever the number of rows.  There the scatter ``C`` is
factored as ``P L L' P'`` with the largest remaining diagonal as the pivot, until what remains is
rounding.  One-sided Jacobi then turns pairs of columns of ``L`` against each other until all are
at right angles: their norms squared are the eigenvalues of the scatter and the columns, made one
long and put back into the order of the dimensions, are the components; ``C`` itself is not
needed again, so small eigenvalues keep their digits.

Edge cases: rows whose vector is null, empty, or holds a null or non-finite entry take no part; so
do vectors of another length than most rows have (ties: the longer), as they have no place in one
covariance.  Directions without any spread have no whitened value: components end at the rank, so
there are none where all rows are equal.  Repeated rows and null ids are rows like others; an empty
table gives an empty one.  ``deviation`` is null where it does not fit into a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, on_executors

SCALE, SHIFT, FURTHEST = 1024, 100_000, 2.0 ** 42
#: Rows that are centred and multiplied at a time.
BLOCK = 4096
_EPS = float(np.finfo(np.float64).eps)


def grid_vectors(rows: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, x): the rows that take part, with entries as longs ``floor(1024 c) + 100000``."""
    c = F.col(f"`{column}`").cast("array<double>")
    good = c.isNotNull() & (F.size(c) > 0) & F.forall(c, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False)))
    x = F.transform(c, lambda v: F.floor(F.greatest(F.least(v, F.lit(FURTHEST)), F.lit(-FURTHEST)) * SCALE).cast("long") + SHIFT)
    valid = rows.where(good).select(F.col(f"`{key}`").alias("id"), x.alias("x"))
    most = valid.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    return valid.where(F.size("x") == (most["dim"] if most else 0))


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def scatter(rows: DataFrame, dim: int, column: str = "x") -> tuple[int, list[int], np.ndarray]:
    """(n, sums, scatter): the scatter sums products of entries that are centred first."""
    n, *sums = rows.agg(F.count("*"), *[F.sum(F.get(column, F.lit(j)).cast("decimal(19,0)")) for j in range(dim)]).first()
    if not n:
        return 0, [0] * dim, np.zeros((dim, dim))
    sums = [int(s) for s in sums]
    mean = np.array([s / n for s in sums])

    def partial(parts):
        total = np.zeros((dim, dim))
        for batch in parts:
            for at in range(0, batch.num_rows, BLOCK):
                y = _matrix(batch.column(0).slice(at, BLOCK), dim) - mean
                total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))],
                                         names=["i", "row"])

    parts = rows.select(column).mapInArrow(partial, "i int, row array<double>")
    summed = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((dim, dim))
    for i, j, v in summed.toLocalIterator():  # dim * dim numbers
        out[i, j] = v
    return n, sums, (out + out.T) / 2


def pivoted_cholesky(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): ``c[order][:, order] = L L'``, L with as many columns as the rank."""
    dim = len(c)
    rest, order, left = np.diag(c).copy(), np.arange(dim), np.zeros((dim, dim))
    least = rest.max(initial=0.0) * dim * _EPS
    for k in range(dim):
        p = k + int(np.argmax(rest[order[k:]]))
        if rest[order[p]] <= least:
            return left[order][:, :k], order
        order[[k, p]] = order[[p, k]]
        pivot, below = order[k], order[k + 1:]
        left[pivot, k] = np.sqrt(rest[pivot])
        left[below, k] = (c[below, pivot] - left[below, :k] @ left[pivot, :k]) / left[pivot, k]
        rest[below] -= left[below, k] ** 2
    return left[order], order


def one_sided_jacobi(a: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``a`` with its columns turned in pairs until all are at right angles; the pairs of a round
    share no column, so a round is done at once."""
    a = a.copy()
    n = a.shape[1]
    ring = np.arange(n + n % 2)
    for _ in range(sweeps):
        turned = False
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            p, q = ring[:half], ring[half:][::-1]
            on = (p < n) & (q < n)
            p, q = p[on], q[on]
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            do = np.abs(xy) > _EPS * np.sqrt(xx * yy)
            if do.any():
                turned = True
                slope = np.where(do, (yy - xx) / np.where(do, 2 * xy, 1), 0)
                t = np.where(slope >= 0, 1, -1) / (np.abs(slope) + np.hypot(1, slope))
                cos = np.where(do, 1 / np.hypot(1, t), 1)
                sin = np.where(do, t * cos, 0)
                a[:, p], a[:, q] = cos * x - sin * y, sin * x + cos * y
            ring = np.concatenate((ring[:1], ring[-1:], ring[1:-1]))
        if not turned:
            break
    return a


def components(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as columns) of a scatter, the largest first, up to its rank; of each
    component the entry furthest from zero is positive."""
    left, order = pivoted_cholesky(c)
    turned = one_sided_jacobi(left)
    norm = np.sqrt((turned * turned).sum(0))
    by = np.argsort(-norm, kind="stable")
    vectors = np.zeros_like(turned)
    vectors[order] = turned[:, by] / norm[by]
    if vectors.size:
        at = np.abs(vectors).argmax(0)
        vectors *= np.where(vectors[at, np.arange(len(by))] < 0, -1.0, 1.0)
    return norm[by] ** 2, vectors


def whiten(rows: DataFrame, most: int = 8, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error): each remaining row with its values on the
    first components, at most ``most``; ``explained`` has the components' shares of the variance."""
    spark = rows.sparkSession
    on_executors(spark)
    known = T.StructField("id", rows.schema[key].dataType)
    x = cut(grid_vectors(rows, key, column), "grid")
    first = x.first()
    dim = len(first["x"]) if first else 0
    n, sums, c = scatter(x, dim)
    values, vectors = components(c)
    k = min(most, len(values))
    shares = (values[:k] / np.trace(c)).tolist() if k else []
    onto = vectors[:, :k] / np.sqrt(values[:k] / max(n, 1))
    mean, exact = np.array([s / max(n, 1) for s in sums]), np.array(sums, object)
    wrapped = np.array([s & (1 << 64) - 1 for s in sums], np.uint64).view(np.int64)  # differences that fit come out right
    schema = T.StructType([known, T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def project(parts):
        for batch in parts:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                y = _matrix(part.column(1), dim)
                far = ((y - mean) * float(n)) ** 2
                small = far.sum(1) < 2.0 ** 62
                apart = np.zeros(len(y), np.int64)
                if small.any():
                    apart[small] = ((n * y[small] - wrapped) ** 2).sum(1)
                for i in np.flatnonzero(~small):
                    total = int(((n * y[i].astype(object) - exact) ** 2).sum())
                    small[i], apart[i] = total < 1 << 63, total if total < 1 << 63 else 0
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(apart, pa.int64(), mask=~small), pa.array(list((y - mean) @ onto), pa.list_(pa.float64()))],
                    names=["id", "deviation", "whitened"])

    done = cut(x.mapInArrow(project, schema), "whitened")
    error = identity_error(done.select("whitened"), k)
    return done.select("id", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                       F.lit(shares).cast("array<double>").alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def identity_error(rows: DataFrame, k: int) -> float:
    """The largest entry by which the covariance of ``whitened`` differs from the identity."""
    if not k:
        return 0.0
    at = [F.get("whitened", F.lit(j)) for j in range(k)]
    means = rows.agg(*[F.avg(c) for c in at]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = rows.agg(*[F.avg((at[i] - means[i]) * (at[j] - means[j])) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))


def report(rows: DataFrame) -> DataFrame:
    """A row for each vector that takes part and each of its first eight components."""
    done = whiten(rows.select("vec_id", "embedding"), 8)
    each = done.select(F.col("id").alias("vec_id"), "n", "deviation", "identity_error",
                       F.posexplode(F.arrays_zip("whitened", F.slice("explained", 1, 8).alias("explained"))).alias("at", "v"))
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("v.whitened").alias("whitened"),
                       F.col("v.explained").alias("explained"), "identity_error")
