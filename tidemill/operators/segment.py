"""Words of text without spaces, by a dictionary.

A dictionary of weighted words becomes a double-array trie: two integer arrays in which the child
of node ``s`` by character ``c`` is ``base[s] + c`` if ``check`` there is ``s``.  It goes to all
tasks, so its size is bounded by a parameter (the heaviest words stay).  A run of characters is
cut either by ``longest`` match from the left, or along the ``best`` path: the cut whose words
have the greatest product of frequencies, found from the right over the words that begin at each
place (of equal cuts, the one whose first word is longer).  A character that begins no word
stands alone.  The words of a run put together are the run.

Null text has null words; a text without runs has no words; an empty dictionary gives characters.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from ..session import ship_package

__all__ = ["CJK_RUN", "MOST_WORDS", "DoubleArrayTrie", "segment"]

#: Runs of Chinese characters (with the extension A and compatibility blocks).
CJK_RUN = "[㐀-䶿一-鿿豈-﫿]+"
#: Words that a dictionary keeps, the heaviest first.
MOST_WORDS = 1 << 18
_STRETCH = 256


class DoubleArrayTrie:
    """Words as a double array; ``value`` has the log frequency at a word's last node."""

    def __init__(self, words: list[str], weights: list[float]):
        total = sum(weights) or 1.0
        signs = {c: k + 1 for k, c in enumerate(sorted({c for w in words for c in w}))}
        children: list[dict[int, int]] = [{}]
        ends: dict[int, float] = {}
        for word, weight in zip(words, weights):
            node = 0
            for c in word:
                code = signs[c]
                if code not in children[node]:
                    children[node][code] = len(children)
                    children.append({})
                node = children[node][code]
            ends[node] = math.log(weight / total)
        size = 2 * len(children) + len(signs) + 2
        base, check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        value = np.full(size, np.nan)
        place, check[0], free, tail = {0: 0}, 0, len(signs) + 1, 1
        for node, below in enumerate(children):  # parents come before their children
            at = place[node]
            if node in ends:
                value[at] = ends[node]
            if not below:
                continue
            codes = np.array(sorted(below))
            while free < len(check) and check[free] >= 0:
                free += 1
            # Nodes with several children go near the end; holes that they leave are filled by the others.
            low = free if len(codes) == 1 else max(free, tail - 4 * _STRETCH)
            while True:  # the first places that are free for all children, looked for a stretch at a time
                if low + _STRETCH + codes[-1] >= len(check):
                    more = len(check) + _STRETCH
                    base, check = np.append(base, np.zeros(more, np.int64)), np.append(check, np.full(more, -1, np.int64))
                    value = np.append(value, np.full(more, np.nan))
                spots = low + np.flatnonzero(check[low:low + _STRETCH] < 0)
                fits = (check[(spots - codes[0])[:, None] + codes] < 0).all(1) if len(codes) > 1 else spots >= 0
                if fits.any():
                    first = int(spots[fits.argmax()] - codes[0])
                    break
                low += _STRETCH
            base[at] = first
            check[first + codes] = at
            tail = max(tail, first + int(codes[-1]))
            place.update((below[c], first + c) for c in codes.tolist())
        self.signs, self.base, self.check, self.value = signs, base, check, value
        self.alone = math.log(0.5 / total)  # a character that is no word: rarer than any word

    def unpacked(self) -> "DoubleArrayTrie":
        """The arrays as lists, which single reads are faster from."""
        self.base, self.check, self.value = (list(x) if isinstance(x, list) else x.tolist() for x in (self.base, self.check, self.value))
        return self

    def words_at(self, run: str, at: int) -> list[tuple[int, float]]:
        """(end, log frequency) of the words that begin at a place, the shortest first."""
        out, node = [], 0
        for end in range(at, len(run)):
            code = self.signs.get(run[end])
            if code is None:
                break
            child = self.base[node] + code
            if child >= len(self.check) or self.check[child] != node or child == 0:
                break
            node = child
            if self.value[node] == self.value[node]:
                out.append((end + 1, self.value[node]))
        return out

    def longest(self, run: str) -> list[str]:
        out, at = [], 0
        while at < len(run):
            found = self.words_at(run, at)
            end = found[-1][0] if found else at + 1
            out.append(run[at:end])
            at = end
        return out

    def best(self, run: str) -> list[str]:
        n = len(run)
        score, step = [0.0] * (n + 1), [0] * n
        for at in range(n - 1, -1, -1):
            score[at], step[at] = self.alone + score[at + 1], at + 1
            for end, weight in self.words_at(run, at):
                if weight + score[end] >= score[at] - 1e-12:
                    score[at], step[at] = weight + score[end], end
        out, at = [], 0
        while at < n:
            out.append(run[at:step[at]])
            at = step[at]
        return out


def segment(df: DataFrame, column: str, dictionary: DataFrame, out: str = "words", pattern: str = CJK_RUN, mode: str = "best",
            most: int = MOST_WORDS) -> DataFrame:
    """``df`` with ``out``: the words, in order, of all runs of ``pattern`` in a text column.

    ``dictionary`` has ``word`` and ``weight``; repeated words add up, words without weight are left out.
    """
    ship_package(df.sparkSession)
    words = dictionary.where("word <> '' and weight > 0").groupBy("word").agg(F.sum("weight").cast("double").alias("weight"))
    table = words.orderBy(F.desc("weight"), "word").limit(most).toArrow()  # at most ``most`` rows
    sent = df.sparkSession.sparkContext.broadcast(DoubleArrayTrie(table["word"].to_pylist(), table["weight"].to_pylist()))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(f"`{column}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("words", T.ArrayType(T.StringType()))])

    def run(parts):
        trie, runs, known = sent.value.unpacked(), re.compile(pattern), {}
        cut = trie.best if mode == "best" else trie.longest
        for batch in parts:
            done = []
            for text in batch.column(1).to_pylist():
                found = None if text is None else []
                for r in runs.findall(text or ""):
                    own = known.get(r)
                    if own is None:
                        if len(known) > 1 << 16:
                            known.clear()
                        own = known[r] = cut(r)
                    found.extend(own)
                done.append(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(done, pa.list_(pa.string()))], names=["row", "words"])

    return rows.mapInArrow(run, schema).select("row.*", F.col("words").alias(out))
