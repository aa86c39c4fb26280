import numpy as np

from tidemill.llm import hnsw as H


def exact(ids, x, qid, k):
    score = x @ x[list(ids).index(qid)]
    order = np.lexsort((ids, -np.round(score, 12)))
    return [int(ids[i]) for i in order if ids[i] != qid][:k]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_recall_on_graph(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 24)).astype(np.float32).astype(float) * rng.uniform(0.2, 3, (3000, 1)).astype(np.float32)
    rows = H.vectors(frame(spark, [(i, [float(f) for f in v]) for i, v in enumerate(x.astype(np.float32))]))
    x = x.astype(np.float32).astype(float)
    got = H.search_index(H.build_index(rows, shards=2), rows.where("id % 60 = 0"), k=10).toPandas()
    hits = sum(len(set(g["vec_id"]) & set(exact(np.arange(3000), x, q, 10))) for q, g in got.groupby("query_id"))
    assert hits / len(got) > 0.9 and len(got) == 50 * 10
    for r in got.head(50).itertuples():
        assert abs(r.score - x[r.query_id] @ x[r.vec_id]) < 1e-9


def test_copies_and_ties_are_whole(spark):
    rows = [(i, [1.0, 0.0]) for i in range(300)] + [(1000 + i, [0.5, 0.1 * i]) for i in range(5)]
    found = H.vectors(frame(spark, rows))
    got = H.search_index(H.build_index(found, shards=3), found.where("id = 40 or id = 1000"), k=20).toPandas()
    mine = got[got["query_id"] == 40].sort_values("rank")
    assert mine["vec_id"].tolist() == list(range(20)) and mine["rank"].tolist() == list(range(1, 21))
    assert got[got["query_id"] == 1000].sort_values("rank")["vec_id"].tolist() == list(range(20))


def test_few_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, []), (None, [1.0, 1.0]), (9, [1.0, 1.0, 1.0]), (20, [3.0, 1.0]), (20, [3.0, 1.0])]
    found = H.vectors(frame(spark, rows))
    got = H.search_index(H.build_index(found), found, k=20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got if r.query_id == 1) == [(1, 1, 20, 5.0), (1, 2, 2, 4.0)]
    assert {r.query_id for r in got} == {1, 2, 20}
    none = H.vectors(frame(spark, []))
    assert H.search_index(H.build_index(none), none).count() == 0


def test_repeated_ids_are_one_row(spark):
    """Rows of one id, equal or not, are one query and one candidate: twenty neighbours are twenty ids."""
    rng = np.random.default_rng(7)
    rows = [(i, [float(f) for f in v]) for i, v in enumerate(rng.normal(size=(42, 6)).astype(np.float32))]
    rows += [rows[20], rows[20], (20, [9.0] * 6), (7, [8.0] * 6), (7, [-9.0] * 6)]
    least = {}
    for i, v in rows:
        least[i] = min(least.get(i, v), v)
    x = np.array([least[i] for i in range(42)])
    found = H.vectors(frame(spark, rows))
    got = H.search_index(H.build_index(found), found.where("id in (7, 20)"), k=20).toPandas()
    assert len(got) == 40
    for q, g in got.groupby("query_id"):
        assert g.sort_values("rank")["vec_id"].tolist() == exact(np.arange(42), x, q, 20)


def test_recall_on_embeddings_through_the_graph(spark):
    from tidemill.llm import queries as Q

    sf = "/root/testdata/sf0.1"
    own = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    x = np.stack(own["embedding"]).astype(float)
    ids = own["vec_id"].to_numpy()
    got = Q.op2_hnsw(spark, sf).toPandas()
    hits = sum(len(set(g["vec_id"]) & set(exact(ids, x, q, 20))) for q, g in got.groupby("query_id"))
    assert len(got) == 20 * len(ids[ids % 20 == 0]) and hits >= 0.95 * len(got)
