import numpy as np
from pyspark.sql import functions as F

from tidemill.llm import whitening as W

SF = "/root/testdata/sf0.01"


def test_against_eigenvectors_of_the_covariance(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    out = W.report(rows).toPandas()
    own = rows.toPandas().sort_values("vec_id")
    x = np.floor(1024 * np.stack(own["embedding"]).astype(float)).astype(np.int64) + 100_000
    n = len(x)
    values, vectors = np.linalg.eigh(np.cov(x.T.astype(float), bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    want = (x - x.mean(0)) @ vectors[:, :8] / np.sqrt(values[:8])
    wide = out.pivot(index="vec_id", columns="component", values="whitened")
    assert wide.shape == (n, 8)
    got = wide.to_numpy()
    sign = np.sign((got * want).sum(0))
    assert np.abs(got * sign - want).max() < 1e-9
    one = out[out.component == 1].sort_values("vec_id")
    assert (one["deviation"].to_numpy() == ((n * x - x.sum(0)) ** 2).sum(1)).all()
    assert np.allclose(out.groupby("component")["explained"].first(), values[:8] / values.sum(), rtol=1e-9)
    assert (out["n"] == n).all() and out["identity_error"].max() < 1e-9


def test_factor_and_turns():
    rng = np.random.default_rng(4)
    for shape in ((50, 7), (50, 8), (3, 6), (40, 1)):
        y = rng.standard_normal(shape) * 10.0 ** rng.integers(-3, 4, shape[1])
        c = y.T @ y
        left, order = W.pivoted_cholesky(c)
        assert left.shape[1] == min(shape) and np.allclose(np.triu(left, 1), 0)
        assert np.allclose(left @ left.T, c[order][:, order], rtol=1e-9, atol=1e-9 * np.trace(c))
        values, vectors = W.components(c)
        assert np.allclose(values, np.linalg.eigvalsh(c)[::-1][:len(values)], rtol=1e-7, atol=1e-12 * np.trace(c))
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-9
    assert W.components(np.zeros((4, 4)))[1].shape == (4, 0)


def test_rows_that_take_no_part_and_equal_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [1.0, 2.0]), (2, [3.0, 5.0]), (2, [3.0, 5.0]), (None, [0.0, -1.0]), (4, None), (5, []), (6, [1.0, None]), (7, [nan, 1.0]),
            (8, [inf, 1.0]), (9, [1.0]), (10, [-inf, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit("own"), "n": F.lit(7)})
    got = W.report(df).collect()
    assert sorted((r["vec_id"], r["component"]) for r in got if r["vec_id"]) == [(1, 1), (1, 2), (2, 1), (2, 1), (2, 2), (2, 2)]
    assert len(got) == 8 and {r["n"] for r in got} == {4}
    equal = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], df.select("vec_id", "embedding").schema)
    assert W.report(equal).count() == 0  # no direction has any spread
    assert W.report(df.where("vec_id = 4")).count() == 0
    assert W.report(df.limit(0)).count() == 0


def test_far_entries_have_exact_deviations_or_none(spark):
    rows = [(1, [1e30, 0.0]), (2, [-5e5, 1.0]), (3, [5e5, 2.0])]
    got = {r["vec_id"]: r["deviation"] for r in W.report(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert set(got.values()) == {None}
    near = rows[1:]
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in near]
    want = {i: sum((2 * a - b) ** 2 for a, b in zip(r, map(sum, zip(*x)))) for (i, _), r in zip(near, x)}
    got = {r["vec_id"]: r["deviation"] for r in W.report(spark.createDataFrame(near, "vec_id long, embedding array<double>")).collect()}
    assert got == want
