import numpy as np
import pytest

from tidemill.llm import pieces as P

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vocabulary():
    return P.Vocabulary()


def test_sampling_follows_the_lattice(vocabulary):
    """Frequencies of all segmentations of one word against their exact chances."""
    word = " then"
    pieces = {p.decode(): i for i, p in enumerate(vocabulary.spelled) if i > 258 and p and word.find(p.decode("utf-8", "ignore")) >= 0}
    ways = {}

    def walk(at, ids, weight):
        if at == len(word):
            ways[tuple(ids)] = np.exp(weight)
            return
        for end in range(at + 1, len(word) + 1):
            if word[at:end] in pieces:
                i = pieces[word[at:end]]
                walk(end, [*ids, i], weight + vocabulary.weight[i])

    walk(0, [], 0.0)
    whole = sum(ways.values())
    n = 20000
    ids, count = P.encode_texts(["then"] * n, np.arange(n), P.Lattices(vocabulary), 5)
    seen = {}
    for part in np.split(ids, np.cumsum(count)[:-1]):
        seen[tuple(part.tolist())] = seen.get(tuple(part.tolist()), 0) + 1
    assert set(seen) <= set(ways)
    for way, chance in ways.items():
        assert abs(seen.get(way, 0) / n - chance / whole) < 0.015


def test_runs_of_spaces_are_cut_by_the_whole_lattice(vocabulary):
    """A run of spaces and the word behind it: frequencies of all segmentations against their chances."""
    word = "    a"
    ways = {}

    def walk(at, ids, weight):
        if at == len(word):
            ways[tuple(ids)] = np.exp(weight)
            return
        for i, p in enumerate(vocabulary.spelled):
            if i > 258 and p and word.startswith(p.decode("utf-8", "replace"), at):
                walk(at + len(p), [*ids, i], weight + vocabulary.weight[i])

    walk(0, [], 0.0)
    assert len(ways) > 8  # more than spaces one by one
    n = 20000
    ids, count = P.encode_texts([word[1:]] * n, np.arange(n), P.Lattices(vocabulary), 5)
    seen = {}
    for part in np.split(ids, np.cumsum(count)[:-1]):
        seen[tuple(part.tolist())] = seen.get(tuple(part.tolist()), 0) + 1
    assert set(seen) <= set(ways)
    for way, chance in ways.items():
        assert abs(seen.get(way, 0) / n - chance / sum(ways.values())) < 0.015
    assert P.spell(ids, count, vocabulary.spelling()) == [word[1:].encode()] * n
    assert vocabulary.stretch.findall(" if x\n        y  = 1  ") == [" if", " x", "\n", "        y", "  =", " 1", "  "]


def test_no_piece_crosses_a_stretch(vocabulary):
    spelled = [s.decode("utf-8") for i, s in enumerate(vocabulary.spelled) if i > 258 and s]
    assert all(len(vocabulary.stretch.findall("x" + s)) <= 2 for s in spelled)
    text = " a, b.c »., ’.d\n\n e²f. "
    assert "".join(vocabulary.stretch.findall(text)) == text


def test_lossless_and_reproducible(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    one = P.encode(docs)
    two = P.encode(docs.repartition(9))
    assert one.where("not lossless").count() == 0
    a, b = ({r.doc_id: r.pieces for r in x.select("doc_id", "pieces").collect()} for x in (one, two))
    assert a == b
    assert P.decode(one).where("decoded <> text").count() == 0
    other = {r.doc_id: r.pieces for r in P.encode(docs, seed=6).select("doc_id", "pieces").collect()}
    assert sum(a[i] != other[i] for i in a) > 0.9 * len(a)


def test_edges(spark, edge, empty):
    out = P.encode(edge)
    assert out.columns == [*edge.columns, "pieces", "n_pieces", "lossless"]
    for r in out.collect():
        assert (r.pieces is None) == (r.text is None) == (r.n_pieces is None) and r.lossless in (True, None)
    back = P.decode(out)
    assert back.where("decoded is distinct from text").count() == 0
    assert P.encode(empty).count() == 0
    odd = spark.createDataFrame([(1, "▁ literal \u0000 <0x0A> \t\r\n   ４２ 🏳️‍🌈 ")], "doc_id long, text string")
    assert P.decode(P.encode(odd)).where("decoded = text and lossless").count() == 1
    taken = P.encode(edge.withColumnRenamed("lang", "pieces"))
    assert taken.columns[-3:] == ["pieces_", "n_pieces", "lossless"]
