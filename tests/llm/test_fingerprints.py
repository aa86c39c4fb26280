import hashlib

from pyspark.sql import functions as F

from tidemill.llm import fingerprints as P

SF = "/root/testdata/sf0.01"


def shingles(t):
    w = t.encode().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_report_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(P, "BUCKET_ROWS", 90)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    rows = {r.doc_id: r for r in P.report(docs).collect()}
    assert len(rows) == len(texts)
    off = []
    for k, (i, t) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = rows[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = shingles(t), shingles(edited), shingles(after)
        off += [abs(r.near_edited - len(a & b) / len(a | b)), abs(r.near_next - len(a & c) / len(a | c))]
        if len(a) < P.K:
            assert r.distinct_shingles == len(a)
        else:
            assert abs(r.distinct_shingles / len(a) - 1) < 0.4
    assert sum(off) / len(off) < 0.02 and max(off) < 0.2
    same = {}
    for i, t in texts:
        assert same.setdefault(t, rows[i].fingerprint) == rows[i].fingerprint


def test_sketches_merge_and_contain(spark):
    a, b = " ".join(f"a{k}" for k in range(600)), " ".join(f"b{k}" for k in range(900))
    df = spark.createDataFrame([(a, b, a + " " + b)], "a string, b string, ab string")
    for c in ("a", "b", "ab"):
        df = P.with_sketch(df, c, f"s_{c}")
    s = {c: F.col(f"s_{c}") for c in ("a", "b", "ab")}
    r = df.select(P.resemblance(P.merged(s["a"], s["b"]), s["ab"]).alias("same"), P.containment(s["a"], s["ab"]).alias("inside"),
                  P.containment(s["ab"], s["a"]).alias("outside"), P.resemblance(s["a"], s["ab"]).alias("like")).first()
    assert r.same > 0.95 and r.inside > 0.8 and abs(r.outside - 0.4) < 0.15 and abs(r.like - 0.4) < 0.15


def test_edges(spark, edge, empty):
    rows = P.report(edge).collect()
    assert len(rows) == edge.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].fingerprint == by[6].fingerprint and by[2].fingerprint == by[3].fingerprint == by[4].fingerprint == ""
    assert by[2].near_next == 1.0 and by[1].near_next == 0.0 and by[9].n_chars == 3
    assert P.report(empty).count() == 0
    one = P.report(edge.where("doc_id = 1")).first()
    assert one.near_next == 1.0
