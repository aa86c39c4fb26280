import random

import pytest
from pyspark.sql import functions as F

from tidemill.llm import queries as Q
from tidemill.llm import token_counts as C

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def encode():
    return C.encoder(C.read_ranks()).encode_ordinary


def test_edits_match_counting_again(spark, encode):
    rnd = random.Random(2)
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    for text in [*texts, "", "a", " \n\n x ", "no1safe2cut3" * 200]:
        tree = C.Tree.of(text, encode)
        assert tree.total == len(encode(text))
        for _ in range(8):
            a = rnd.randrange(len(text) + 1)
            b = min(len(text), a + rnd.choice([0, 1, 7, 60, 900]))
            new = rnd.choice(["", " ", "'s", "n't ", "x\n\ny", " 12,3 ", "\U0001F600é", text[:700]])
            tree = C.Tree.again(text, tree.chars, tree.tokens)
            tree.edit(a, b, new, encode)
            text = text[:a] + new + text[b:]
            assert "".join(tree.parts) == text and tree.total == len(encode(text))
            assert tree.chars == C.sums([len(p) for p in tree.parts])
            assert tree.tokens == C.sums([len(encode(p)) for p in tree.parts])


def test_small_edit_of_a_long_text_encodes_little(encode):
    text = "some words of a long text " * 5000
    tree = C.Tree.of(text, encode)
    tree.edit(60_000, 60_003, "new", encode)
    assert tree.encoded < 6 * C.LEAF_CHARS and tree.total == len(encode("".join(tree.parts)))


def test_query_matches_brute_force(spark, encode):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in Q.op7_token_counts(spark, SF).collect():
        t = texts[r.doc_id]
        k = len(t) // 3
        e = t[:k] + t[:40] + t[min(k + 40, len(t)):]
        e = e[:2 * k] + t[-20:] + e[2 * k:]
        assert (r.n_tokens, r.edited_tokens, r.edited_chars) == (len(encode(t)), len(encode(e)), len(e))


def test_edges(edge, empty, encode):
    counted = C.count_tokens(edge)
    assert counted.columns == [*edge.columns, "leaf_chars", "leaf_tokens", "n_tokens"]
    for r in counted.collect():
        assert r.n_tokens == (None if r.text is None else len(encode(r.text)))
    far = F.array(F.struct(F.lit(10**6).alias("start"), F.lit(10**7).alias("end"), F.lit("!").alias("new")),
                  F.struct(F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end"), F.lit(None).cast("string").alias("new")))
    edited = C.apply_edits(counted.withColumn("edits", far))
    for r in edited.collect():
        assert (r.text is None) == (r.n_tokens is None) and (r.text is None or r.text.endswith("!"))
    none = C.apply_edits(counted.withColumn("edits", F.lit(None).cast("array<struct<start:int,end:int,new:string>>")))
    assert none.where("encoded_chars > 0").count() == 0
    assert C.count_tokens(empty).count() == 0
