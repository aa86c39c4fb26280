import copy
import cProfile
import hashlib
import pstats
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import alignment as A

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pair():
    return A.Pair()


def _whole(pair, text):
    """Ids and byte ends of a whole text by both libraries, or nothing where they don't spell it."""
    if not text:
        return None
    a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
    spelled = [[pair.a_spelled[i] for i in a], [pair.b_spelled[i] for i in b]]
    if any(b"".join(s) != (" " + text).encode() for s in spelled):
        return None
    return a, b, *[np.cumsum([len(x) for x in s]).tolist() for s in spelled]


def _brute(pair, texts):
    found, counts = [], Counter()
    for text in texts:
        whole = _whole(pair, text)
        if whole is None:
            found.append(None)
            continue
        a, b, ends_a, ends_b = whole
        links = [(a[i], b[j]) for i, x in enumerate(ends_a) for j, y in enumerate(ends_b) if x == y] if len(a) < 3000 else [
            (a[ends_a.index(x)], b[ends_b.index(x)]) for x in sorted(set(ends_a) & set(ends_b))]
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        counts.update(links)
        found.append((len(a), len(b), groups, links))
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    return [(0, 0, 0, 0, 0, 0, "") if f is None else
            (f[0], f[1], len(f[2]), len(f[3]), sum(counts[p] == top[p[1]] for p in f[3]), sum(counts[p] for p in f[3]),
             hashlib.sha256(";".join(f[2]).encode()).hexdigest()) for f in found]


ODD = ["a▁b", "  x  y\n\n  z \t\tq   ", "<s></s><|endoftext|>  <unk>", "日本語 テキスト　です", "\x1c \x1d\x85   x", "", None,
       "é" * 50 + " " * 40 + "\x00 b", "x" * 5000, "\r\n \r\n", "'s 's'll  't", "👩‍👩‍👧 🇩🇪", "▁", " "]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("sent", [A.SENT_PAIRS, 300, 0])
def test_report_against_brute_force(spark, pair, sent):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    own = [(r["doc_id"], r["text"]) for r in docs.where("length(text) < 4000").collect()] + [(10**6 + i, t) for i, t in enumerate(ODD)]
    own.append(own[0])  # a repeated row
    want = _brute(pair, [t for _, t in own])
    got = _rows(A.report(spark.createDataFrame(own, "doc_id long, text string"), sent))
    assert got == sorted(((i, *w) for (i, _), w in zip(own, want)), key=repr)


def test_texts_that_end_in_one_space(spark, pair):
    texts = ["a ", "two words ", "ends. ", "é ", "😀 ", "line\n ", "a  ", " ", "a ", "two words"]
    want = _brute(pair, texts)
    assert all(w[0] > 0 for w in want)
    got = _rows(A.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 0))
    assert got == sorted(((i, *w) for i, w in enumerate(want)), key=repr)


def test_products_against_dense_matrices():
    rng = np.random.default_rng(2)
    for kind in ("overlap", "group", "ends"):
        for _ in range(30):
            width = int(rng.integers(1, 40))
            ends = [np.unique(np.append(rng.integers(1, width + 1, 8), width)) for _ in range(2)]
            cover = [np.array([[s <= c < e for c in range(width)] for s, e in zip([0, *x[:-1]], x)]) for x in ends]
            i, j, value = A.linked(*ends, width, kind)
            got = np.zeros((len(ends[0]), len(ends[1])), int)
            got[i, j] = value
            if kind == "overlap":
                want = cover[0].astype(int) @ cover[1].T.astype(int)
            elif kind == "ends":
                want = (ends[0][:, None] == ends[1][None, :]).astype(int)
            else:
                both = np.intersect1d(*ends)
                want = (np.searchsorted(both, ends[0])[:, None] == np.searchsorted(both, ends[1])[None, :]).astype(int)
            assert (got == want).all(), kind


def test_products_in_blocks():
    rng = np.random.default_rng(8)
    dense = [rng.integers(0, 2, s) * rng.integers(1, 5, s) for s in ((30, 20), (20, 25))]
    rows = [A.Rows(np.concatenate(([0], np.cumsum((d > 0).sum(1)))), np.nonzero(d)[1], d.shape[1], d[d > 0]) for d in dense]
    for block in (1, 7, 1 << 20):
        p = rows[0].times(rows[1], block)
        got = np.zeros((30, 25), int)
        got[p.owners(), p.at] = p.value
        assert (got == dense[0] @ dense[1]).all()


def test_kinds_of_links(spark, pair):
    text = "unbelievable tokenizers"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    a, b, ends_a, ends_b = _whole(pair, text)
    starts_a, starts_b = [0, *ends_a[:-1]], [0, *ends_b[:-1]]
    want = Counter(x * pair.b_width + y for x, s, e in zip(a, starts_a, ends_a) for y, t, f in zip(b, starts_b, ends_b) if s < f and t < e)
    r = A.align(df, "overlap").first()
    assert dict(zip(r["pairs"], r["times"])) == want and r["n_links"] == sum(want.values())
    assert A.align(df, "group").first()["n_links"] >= r["n_groups"]


def test_edge_rows(edge, empty):
    out = A.align(edge.withColumn("groups", F.lit("own")))
    assert out.count() == edge.count()
    for r in out.collect():
        assert r["groups"] == "own"
        if not r["text"]:
            assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_"], r["pairs"]) == (0, 0, 0, 0, "", [])
        else:
            assert r["n_groups"] > 0 and sum(r["times_"]) == r["n_links"]
    assert A.report(edge).count() == edge.count()
    assert A.report(empty).count() == 0


def test_pieces_encoded_together_are_those_encoded_alone(pair):
    texts = ["word%d" % i for i in range(3 * A.AT_ONCE)] + ["  wide %d\n  é" % i for i in range(A.AT_ONCE)] + ["a▁b", "日本", "\x00.", "tail ", "tail\n"]
    pieces = [p for t in texts for p in pair.pieces(t)]
    blocks = A.Blocks(pair)
    slots = blocks.slots(pieces)
    for piece, slot in zip(pieces, slots.tolist()):
        a, b = pair.a.encode(" " + piece, add_special_tokens=False).ids, pair.b.encode(piece) if piece else pair.b_space.tolist()
        spelled = all(b"".join(s[i] for i in ids) == (" " + piece).encode() for ids, s in ((a, pair.a_spelled), (b, pair.b_spelled)))
        n_a, n_b, n_groups, good = blocks.n[slot].tolist()
        shown = blocks.shown[slot].as_py()
        assert (n_a, n_b, good) == ((len(a), len(b), 1) if spelled else (0, 0, 0)), piece
        groups = [g.split("|") for g in shown.split(";")] if shown else []
        assert len(groups) == n_groups == blocks.ends[slot + 1] - blocks.ends[slot]
        assert [",".join(g[k] for g in groups) for k in (0, 1)] == [",".join(map(str, x)) if spelled else "" for x in (a, b)]


def test_work_on_new_pieces(pair):
    """B takes few pieces at once, and Python makes few calls for each new piece (counted, not timed)."""
    pieces = [p for t in ("x%dy z%d" % (i, i) for i in range(5000)) for p in pair.pieces(t)]
    sizes = []

    class Recorded:
        def encode(self, text, **options):
            sizes.extend(len(t.split()) for t in ([text] if isinstance(text, str) else text))
            return pair.b.encode(text, **options)

    watched = copy.copy(pair)
    watched.b = Recorded()
    blocks = A.Blocks(watched)
    profile = cProfile.Profile()
    slots = profile.runcall(blocks.slots, pieces)
    assert len(slots) == len(blocks) == 10000
    assert sum(sizes) == 10000 and max(sizes) <= A.AT_ONCE
    assert pstats.Stats(profile).total_calls < 12 * len(blocks)
