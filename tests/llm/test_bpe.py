import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemill.llm import bpe

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def pieces():
    return bpe.Pieces(bpe._read(bpe.VOCABULARY))


def _ids(pieces, text):
    return pieces.encode([text.encode()])[0].tolist()


def test_random_texts_are_encoded_as_the_library_does(pieces, library):
    rnd = random.Random(11)
    kinds = ["aab", "etaoin shrdlu'st'll", "日本語 αΣσİ́é \x1c\x85　", "0123 !?.--==__", "aeiourstlnAEIO"]
    for k in range(1500):
        text = "".join(rnd.choice(rnd.choice(kinds)) for _ in range(rnd.randint(0, 40)))
        if k % 5 == 0:
            text += "<|endoftext|>" + text + " <|startoftext|>́x<|endoftext"
        if k % 7 == 0:
            text = "".join(chr(rnd.choice([rnd.randint(1, 0xD7FF), rnd.randint(0xE000, 0x10FFFF)])) for _ in range(20))
        assert _ids(pieces, text) == library.encode(text, add_special_tokens=False).ids, text


def test_side_by_side_is_what_merging_leaves(pieces, library):
    rnd, v = random.Random(3), pieces.vocabulary
    plain = [i for i, s in v.symbols.items() if s.isascii() and s.isalpha()]
    ends = [i for i, s in v.symbols.items() if s[:-1].isascii() and s[:-1].isalpha() and chr(ord(s[-1]) % 256).isalpha() and ord(s[-1]) >= 256]
    for _ in range(3000):
        a, b = rnd.choice(plain), rnd.choice(ends)
        text = "".join(chr(ord(c) % 256) for c in v.symbols[a] + v.symbols[b])
        if text.isascii() and text == text.lower():
            assert v.may_follow(a, b) == (library.encode(text, add_special_tokens=False).ids == [a, b]), text


def test_long_unbroken_words(pieces, library):
    for text in ("a" * 50_000, "ab" * 50_000, "日" * 30_000, "=-" * 40_000):
        assert _ids(pieces, text) == library.encode(text, add_special_tokens=False).ids


def test_pieces_encoded_together_are_encoded_as_alone(pieces, library):
    rnd = random.Random(5)
    odd = ["a\ue000b", "\ue000", "\ue000\ue000é", "é\ue000", "<|endoftext|>é", "x<|startoftext|><|endoftext|>\ue000", "\u0301", "e\u0301'", "'s",
           "\u3000", "\u00a0é\u00a0", "\x1c", "\x1cé", "É", "İ", "Don't", "\x7f", "日本", "0", "ΑΣ", "\n", "\u1100", "\u1161", "\ufeff"]
    texts = [rnd.choice(" \n\t").join(rnd.choice(odd) + rnd.choice(["", "", "x", rnd.choice(odd)]) for _ in range(rnd.randint(0, 30))) for _ in range(400)]
    ids, count = pieces.encode([t.encode() for t in texts])
    assert ids.tolist() == [i for t in texts for i in library.encode(t, add_special_tokens=False).ids]
    assert count.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_a_word_in_several_pieces_is_encoded_once(library, monkeypatch):
    pieces, asked = bpe.Pieces(bpe._read(bpe.VOCABULARY)), []
    word = bpe.Vocabulary.word
    monkeypatch.setattr(bpe.Vocabulary, "word", lambda self, w: asked.append(w) or word(self, w))
    text = "zorbling zorbling, Zorbling. zorbling's (zorbling) Übzor, übzor"
    assert _ids(pieces, text) == library.encode(text, add_special_tokens=False).ids
    assert len(asked) == len(set(asked))


def test_forgetting_pieces_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 400)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 200)
    small = bpe.Pieces(bpe._read(bpe.VOCABULARY))
    for text in ("one two three four five", "three seven", "one one one", "eight nine ten eleven", "two"):
        assert _ids(small, text) == library.encode(text, add_special_tokens=False).ids


def test_report_on_documents(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in bpe.report(docs).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[doc_id] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_edge_rows(edge, empty, library):
    done = bpe.decode(bpe.encode(edge.withColumn("ids", F.lit("own")), column="text"), column="ids_")
    for r in done.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids_"] == ids and r["n_tokens"] == len(ids) and r["ids"] == "own"
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.report(empty).count() == 0
    nulls = edge.limit(2).select(F.lit(None).cast("array<int>").alias("ids"))
    assert [r["decoded"] for r in bpe.decode(nulls).collect()] == [None, None]
