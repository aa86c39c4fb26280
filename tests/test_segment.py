"""Dictionary segmentation against all cuts of a run."""

import itertools
import math
import random

from table_paths import SF_SMALL
from tidemill.operators.segment import DoubleArrayTrie, segment
from tidemill.plans import queries as Q


def _cuts(run):
    for marks in itertools.product((0, 1), repeat=max(0, len(run) - 1)):
        out = [run[0]]
        for c, m in zip(run[1:], marks):
            if m:
                out.append(c)
            else:
                out[-1] += c
        yield out


def test_best_path_against_all_cuts():
    rnd = random.Random(6)
    for _ in range(60):
        words = {"".join(rnd.choice("天地人日月") for _ in range(rnd.randint(1, 4))): rnd.randint(1, 50) for _ in range(25)}
        trie = DoubleArrayTrie(list(words), list(words.values())).unpacked()
        total = sum(words.values())
        run = "".join(rnd.choice("天地人日月火") for _ in range(9))
        score = lambda cut: sum(math.log(words[w] / total) if w in words else math.log(0.5 / total) for w in cut)
        allowed = [c for c in _cuts(run) if all(w in words or len(w) == 1 for w in c)]
        best = trie.best(run)
        assert "".join(best) == run and abs(score(best) - max(map(score, allowed))) < 1e-9
        left, longest = run, []
        while left:
            longest.append(next((left[:n] for n in range(len(left), 0, -1) if left[:n] in words), left[0]))
            left = left[len(longest[-1]):]
        assert trie.longest(run) == longest


def test_trie_holds_exactly_its_words():
    rnd = random.Random(9)
    words = list({"".join(rnd.choice("abcdefghij日本") for _ in range(rnd.randint(1, 7))) for _ in range(4000)})
    trie = DoubleArrayTrie(words, [1.0] * len(words)).unpacked()
    known = set(words)
    for _ in range(3000):
        run = "".join(rnd.choice("abcdefghij日本x") for _ in range(8))
        assert [run[:end] for end, _ in trie.words_at(run, 0)] == [run[:n] for n in range(1, 9) if run[:n] in known]


def test_segment_columns_and_edges(spark):
    dictionary = spark.createDataFrame([("中国", 5), ("国人", 4), ("中国人", 1), ("人民", 9), ("", 3), ("民", 0)], "word string, weight long")
    rows = spark.createDataFrame([(1, "中国人民 and 人民x国"), (2, None), (3, "no runs"), (4, ""), (1, "中国人民 and 人民x国")], "id long, row string")
    got = sorted(((r.id, r.words) for r in segment(rows, "row", dictionary).collect()), key=repr)
    assert got == sorted([(1, ["中国", "人民", "人民", "国"])] * 2 + [(2, None), (3, []), (4, [])], key=repr)
    longest = segment(rows.where("id = 1").limit(1), "row", dictionary, mode="longest").first()["words"]
    assert longest == ["中国人", "民", "人民", "国"]
    assert segment(rows.where("id = 1").limit(1), "row", dictionary.limit(0)).first()["words"] == list("中国人民人民国")
    assert segment(rows.limit(0), "row", dictionary).count() == 0
    # a dictionary of the two heaviest words
    assert segment(rows.where("id = 1").limit(1), "row", dictionary, most=2).first()["words"] == ["中国", "人民", "人民", "国"]


def test_words_of_all_documents_spell_their_runs(spark):
    import re

    total = lambda df: sum(len(r["word"]) * r["n"] for r in df.collect())
    letters = sum(len("".join(re.findall(Q._LETTERS, (r["text"] or "").lower())))
                  for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect())
    assert total(Q.QUERIES["segment_best"](spark, SF_SMALL)) == letters
