import random
from collections import defaultdict

import numpy as np
import pytest

from tidemill.llm import minhash as M
from tidemill.llm.components import components


def sets(rows):
    out = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        out[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def brute(rows, percent):
    s, up = sets(rows), {i: i for i, _ in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    where = defaultdict(list)
    for i in s:
        for g in s[i]:
            where[g].append(i)
    both = defaultdict(int)
    for ids in where.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1:]:
                both[a, b] += 1
    for (a, b), c in both.items():
        if 100 * c >= percent * (len(s[a]) + len(s[b]) - c):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(s[i]), root(i), root(i) == i) for i in s}


@pytest.mark.parametrize("percent", [80, 85])
def test_classes_match_brute_force(spark, percent):
    rnd = random.Random(percent)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for group in range(12):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 6, 40, 120]))]
        for _ in range(rnd.choice([1, 2, 25])):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 4])):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            rows.append((len(rows), " ".join(w)))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(df, percent).collect()}
    assert got == brute(rows, percent)


def test_blocks_of_a_large_group_keep_every_link(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 4)
    base = [f"w{k}" for k in range(60)]
    rows = [(i, " ".join(base[:i % 50] + [f"x{i}"] + base[i % 50:])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(df, 80).collect()}
    assert got == brute(rows, 80)


def test_odd_sketch_estimates_high_similarity():
    rng = np.random.default_rng(1)
    for same in (0.95, 0.9, 0.8):
        n = 4000
        shared = rng.integers(0, 2**63, int(n * same * 2 / (1 + same)), dtype=np.uint64)
        a, b = (np.concatenate((shared, rng.integers(0, 2**63, n - len(shared), dtype=np.uint64))) for _ in range(2))
        o = M.odd_sketches(np.array([M.samples(a), M.samples(b)]))
        odd = int(np.bitwise_count(o[0] ^ o[1]).sum())
        assert abs(M.estimate(odd) - len(shared) / (2 * n - len(shared))) < 0.12


def test_edges(edge, empty):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in M.near_duplicates(edge).collect()}
    assert got[1] == (2, 1, True) and got[6] == (2, 1, False)
    assert got[2] == (0, 2, True) and got[3] == (0, 3, True) and got[4] == (0, 4, True) and got[9] == (1, 9, True)
    assert None not in got and len(got) == 7
    kept = M.drop_near_duplicates(edge)
    assert kept.columns == edge.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 9]
    assert M.near_duplicates(empty).count() == 0 and M.drop_near_duplicates(empty).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(8, 60)] + [(3, 3), (5, 4)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 100 for k in range(100, 161)) and all(got[k] == 7 for k in range(7, 60))
    assert got[5] == got[4] == 4 and 3 not in got
