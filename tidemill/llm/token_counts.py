"""Edit-aware token counts: segment trees over the pre-tokens of each document (operator 7).

A text is cut into leaves of about ``LEAF_CHARS`` characters, each cut at a space between two
letters, where a pre-token always ends: the tokens of the text are those of its leaves one
after another.  A document's tree keeps the sizes of its leaves and, as a heap, the sums of
tokens (and characters) of every subtree; the root is the document's count.

Edits (start, end, replacement; code points of the text before the edit) find the leaves they
touch by descending the tree, widen the region by the leaf on either side (the boundary
context), re-encode only that region, and update the sums on the paths above; when the number of
leaves changes, the sums are made again from the leaves without encoding anything.

The vocabulary file's path is a parameter; the driver reads it and sends the ranks along.
Edge cases: null text has a null tree and count, and edits on it are ignored; empty text has
one empty leaf and no tokens; edits beyond the text are clipped to it, overlapping ones apply
one after another in the order given; texts without a safe cut are one leaf; repeated rows are
counted each for itself; other columns pass through (a new column whose name is taken gets
an underscore).
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import on_executors, packed, unused
from .hashing import text_ranges

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF_CHARS = 256
_SAFE = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")


def read_ranks(path: str = RANKS) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def encoder(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def leaves(text: str, size: int = LEAF_CHARS) -> list[str]:
    """The text in pieces of at least ``size`` characters that end where a pre-token does."""
    out, first = [], 0
    while first + size < len(text):
        m = _SAFE.search(text, first + size)
        if not m:
            break
        out.append(text[first:m.start()])
        first = m.start()
    out.append(text[first:])
    return out


def sums(tokens: list[int]) -> list[int]:
    """A heap of subtree sums over the leaves, padded to a power of two: node ``i`` has the
    children ``2 i`` and ``2 i + 1``, the root is 1 and entry 0 the number of leaves."""
    wide = 1 << max(0, (len(tokens) - 1).bit_length())
    level = np.zeros(wide, np.int64)
    level[:len(tokens)] = tokens
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
    return [len(tokens), *np.concatenate(levels[::-1]).tolist()]


class Tree:
    """Leaf texts of one document with heaps of their sizes in characters and in tokens."""

    def __init__(self, parts: list[str], chars: list[int], tokens: list[int]):
        self.parts, self.chars, self.tokens = parts, chars, tokens
        self.encoded = 0

    @classmethod
    def of(cls, text: str, encode, size: int = LEAF_CHARS) -> "Tree":
        parts = leaves(text, size)
        return cls(parts, sums([len(p) for p in parts]), sums([len(encode(p)) for p in parts]))

    @classmethod
    def again(cls, text: str, chars: list[int], tokens: list[int]) -> "Tree":
        """A stored tree beside its text."""
        wide, n = len(chars) // 2, chars[0]
        ends = np.cumsum(chars[wide:wide + n] if wide else [])
        starts = [0, *ends[:-1].tolist()] if n else []
        return cls([text[a:b] for a, b in zip(starts, ends.tolist())], list(chars), list(tokens))

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _leaf(self, at: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it begins."""
        wide, node, before = len(self.chars) // 2, 1, 0
        while node < wide:
            node *= 2
            if at >= before + self.chars[node]:
                before += self.chars[node]
                node += 1
        leaf = min(node - wide, len(self.parts) - 1)
        return (leaf, before) if leaf == node - wide else (leaf, self.chars[1] - len(self.parts[-1]))

    def edit(self, start: int, end: int, new: str, encode, size: int = LEAF_CHARS) -> None:
        start = max(0, min(start, self.chars[1]))
        end = max(start, min(end, self.chars[1]))
        low, before = self._leaf(start)
        high, _ = self._leaf(max(start, end - 1))
        if low:
            low -= 1
            before -= len(self.parts[low])
        high = min(high + 1, len(self.parts) - 1)
        region = "".join(self.parts[low:high + 1])
        region = region[:start - before] + new + region[end - before:]
        parts = leaves(region, size)
        counts = [len(encode(p)) for p in parts]
        self.encoded += len(region)
        same = len(parts) == high + 1 - low
        self.parts[low:high + 1] = parts
        for heap, values in ((self.chars, [len(p) for p in parts]), (self.tokens, counts)):
            wide = len(heap) // 2
            if same:
                for i, v in enumerate(values):
                    node, more = wide + low + i, v - heap[wide + low + i]
                    while more and node:
                        heap[node] += more
                        node //= 2
            else:
                n = heap[0]
                heap[:] = sums([*heap[wide:wide + low], *values, *heap[wide + high + 1:wide + n]])


_TREE = [T.StructField("leaf_chars", T.ArrayType(T.LongType())), T.StructField("leaf_tokens", T.ArrayType(T.LongType())),
         T.StructField("n_tokens", T.LongType())]


def count_tokens(docs: DataFrame, ranks: str = RANKS, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``docs`` with its segment trees (``leaf_chars``, ``leaf_tokens``) and ``n_tokens``."""
    on_executors(docs.sparkSession)
    table = read_ranks(ranks)
    rows = packed(docs)
    at = docs.columns.index("text")

    def run(parts):
        encode = encoder(table).encode_ordinary
        for batch in parts:
            for first, last, texts in text_ranges(batch.column(0).field(at)):
                trees = [None if t is None else Tree.of(t, encode, leaf_chars) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, last - first), pa.array([t and t.chars for t in trees], pa.list_(pa.int64())),
                    pa.array([t and t.tokens for t in trees], pa.list_(pa.int64())),
                    pa.array([None if t is None else t.total for t in trees], pa.int64())],
                    names=["row", "leaf_chars", "leaf_tokens", "n_tokens"])

    named = [F.col(f.name).alias(unused(f.name, docs.columns)) for f in _TREE]
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], *_TREE])).select("row.*", *named)


def apply_edits(counted: DataFrame, edits: str = "edits", ranks: str = RANKS, leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``counted`` (text and trees) with its column ``edits`` - an array of (start, end, new) - applied:
    text, trees and ``n_tokens`` are those after the edits, ``encoded_chars`` what was encoded for it."""
    on_executors(counted.sparkSession)
    table = read_ranks(ranks)
    rows = packed(counted)
    names = counted.columns
    at = {c: names.index(c) for c in ("text", "leaf_chars", "leaf_tokens", edits)}
    new = [T.StructField("new_text", T.StringType()), *[T.StructField("new_" + f.name, f.dataType) for f in _TREE],
           T.StructField("encoded_chars", T.LongType())]

    def run(parts):
        encode = encoder(table).encode_ordinary
        for batch in parts:
            column = {c: batch.column(0).field(i) for c, i in at.items()}
            for first, last, texts in text_ranges(column["text"]):
                part = {c: texts if c == "text" else x.slice(first, last - first).to_pylist() for c, x in column.items()}
                out = []
                for text, chars, tokens, changes in zip(*(part[c] for c in at)):
                    if text is None:
                        out.append((None, None, None, None, 0))
                        continue
                    tree = Tree.again(text, chars, tokens)
                    for e in changes or []:
                        start, end, put = (e.values() if isinstance(e, dict) else e)
                        tree.edit(start or 0, start or 0 if end is None else end, put or "", encode, leaf_chars)
                    out.append(("".join(tree.parts), tree.chars, tree.tokens, tree.total, tree.encoded))
                kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), *[pa.array(list(v), k) for v, k in zip(zip(*out), kinds)]],
                    names=["row", *[f.name for f in new]])

    done = rows.mapInArrow(run, T.StructType([rows.schema["row"], *new]))
    changed = {"text": "new_text", "leaf_chars": "new_leaf_chars", "leaf_tokens": "new_leaf_tokens", "n_tokens": "new_n_tokens"}
    return done.select(*[F.col(changed.get(c, f"row.`{c}`")).alias(c) for c in names], "encoded_chars")


def sample_edits(text) -> F.Column:
    """Two edits made of the text itself: 40 characters from its beginning replace as many after a
    third, then its last 20 are put in at two thirds."""
    n = F.char_length(text)
    third = F.floor(n / 3).cast("int")
    one = F.struct(third.alias("start"), (third + 40).alias("end"), F.substring(text, 1, 40).alias("new"))
    two = F.struct((2 * third).alias("start"), (2 * third).alias("end"), F.substring(text, -20, 20).alias("new"))
    return F.array(one, two)
