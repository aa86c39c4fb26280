"""Byte-pair encoding by backtracking over longest matches, and decoding by offsets (operator 11).

The vocabulary is a file of merges whose words end in marked symbols (``</w>``).  A word is a row of
symbols, its bytes, of which the last is the marked form.  An Aho-Corasick automaton cuts it from
left to right into longest tokens; where each may stand behind the one before it, that is the
encoding.  Else one pass of an automaton of all reversed tokens over the reversed word gives the
longest token that begins at every symbol, and encoding goes from left to right with ways back: it
takes the longest token that may stand behind the one before it, else the next shorter one, which is
its longest prefix among the tokens; where none fits, the place is marked as dead and the token
before it is tried shorter.  A prefix of a word has one encoding only, so no place is entered twice
and the work is linear in the word.

Two tokens may stand side by side if merging their text from scratch leaves exactly these two.
That is a table over pairs, filled as pairs come up: the symbols on either side of the border live
from the merge that makes them to the merge that takes them into the token, and no merge of such a
pair may fall due while both are alive.

Texts are cut at ASCII white space, which the vocabulary drops, and each distinct piece is encoded
once a task while it is in a bounded memory.  Normal form and pre-tokens of pieces outside ASCII
are the library's own (its tables of letters belong to the format); special tokens in a text are
special tokens, as the library reads them.

Decoding looks tokens up in one byte string with an offset for each id; the format has no decoder,
so tokens are shown with their marks, joined by one space.

The vocabulary file's path is a parameter; the driver reads it and sends the text along.
Edge cases: null or blank text has no tokens, and its decoding is empty; null ids decode to null;
repeated rows are encoded each for itself; other columns pass through (a new column whose name is
taken gets an underscore); an empty table gives an empty one.
"""

from __future__ import annotations

import json
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import on_executors, packed, unused
from .hashing import ranges

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: What a task keeps of encoded pieces and pre-tokens (bytes, with 64 for each), and of the pairs it has looked at.
KEPT, KEPT_WORDS, KEPT_PAIRS = 1 << 25, 1 << 23, 1 << 19
_NEVER = 1 << 62
#: Stands between pieces that go through the library's normal form together, and how many go at once.
_BORDER, _AT_ONCE = "\ue000", 1 << 10


def _byte_signs() -> list[str]:
    """The printable sign of each byte in vocabulary files: itself, or the next free one from U+0100."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


_BORDER_SIGNS = "".join(_byte_signs()[b] for b in _BORDER.encode())


class Vocabulary:
    """Tokens, the merges that make them, and which of them may stand side by side."""

    def __init__(self, text: str):
        import ahocorasick

        whole = json.loads(text)
        model = whole["model"]
        ids: dict[str, int] = model["vocab"]
        mark = model["end_of_word_suffix"] or ""
        byte = {s: b for b, s in enumerate(_byte_signs())}
        size = max([*ids.values(), *[t["id"] for t in whole["added_tokens"]]]) + 1
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        self.shown = [""] * size
        for sign, i in (ids | self.special).items():
            self.shown[i] = sign
        self.symbols: dict[int, str] = {}
        for sign, i in ids.items():
            last = bool(mark) and sign.endswith(mark)
            plain = [byte[s] for s in (sign[:-len(mark)] if last else sign)]
            if last:
                plain[-1] += 256
            self.symbols[i] = "".join(map(chr, plain))
        self.marked = bool(mark)
        self.length = [len(self.symbols.get(i, "")) for i in range(size)]

        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # a token's parts, and when they merge
        for when, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            pair = ids[a], ids[b]
            self.rank[pair] = when
            self.made.setdefault(ids[a + b], (*pair, when))

        known = {s: i for i, s in self.symbols.items()}
        # Tokens that their own merges do not spell again can never come out of an encoding.
        self.reachable = {i for i in known.values() if i not in self.made or self._side_by_side(*self.made[i][:2], self.made[i][2])}
        self.whole = {s: i for s, i in known.items() if i in self.reachable}
        self.shorter = [-1] * size
        self.ahead, self.found = ahocorasick.Automaton(), ahocorasick.Automaton()
        for s, i in known.items():
            if i in self.reachable:
                self.ahead.add_word(s, i)
                self.found.add_word(s[::-1], i)
                for n in range(len(s) - 1, 0, -1):
                    p = known.get(s[:n], -1)
                    if p in self.reachable:
                        self.shorter[i] = p
                        break
        self.ahead.make_automaton()
        self.found.make_automaton()
        self.fits: dict[int, bool] = {}

    def _side_by_side(self, a: int, b: int, until: int = _NEVER) -> bool:
        """Whether merging leaves ``a`` and ``b`` apart, at least up to the merge number ``until``."""
        right, at, end = [], a, until
        while True:
            right.append((at, end))
            if at not in self.made:
                break
            _, at, end = self.made[at]
        at, end = b, until
        while True:
            for x, before in right:
                when = self.rank.get((x, at))
                # Of equal merges the one further left comes first: that inside a beats the border, which beats that inside b.
                if when is not None and when < before and (when <= end and end != until or when < end):
                    return False
            if at not in self.made:
                return True
            at, _, end = self.made[at]

    def may_follow(self, a: int, b: int) -> bool:
        key = a << 32 | b
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > KEPT_PAIRS:
                self.fits.clear()
            known = self.fits[key] = self._side_by_side(a, b)
        return known

    def word(self, row: str) -> list[int]:
        """The token ids of one pre-token, given as its bytes in Latin-1."""
        if self.marked:
            row = row[:-1] + chr(256 + ord(row[-1]))
        whole = self.whole.get(row)
        if whole is not None:
            return [whole]
        out = [token for _, token in self.ahead.iter_long(row)]
        fits, last = self.fits, out[0]
        for token in out[1:]:
            fit = fits.get(last << 32 | token)
            if not fit and (fit is not None or not self.may_follow(last, token)):
                return self._searched(row)
            last = token
        return out

    def _searched(self, row: str) -> list[int]:
        n = len(row)
        # Every symbol is a token, so matches end at each; those that end at one come with the longest first.
        longest, before = [], -1
        for end, token in self.found.iter(row[::-1]):
            if end != before:
                longest.append(token)
                before = end
        out: list[int] = []
        dead: set[int] = set()
        at, last, token = 0, -1, longest[n - 1]
        length, shorter, fits = self.length, self.shorter, self.fits
        while True:
            while token >= 0:
                if at + length[token] not in dead:
                    if last < 0:
                        break
                    fit = fits.get(last << 32 | token)
                    if fit or fit is None and self.may_follow(last, token):
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                if at == n:
                    return out
                last, token = token, longest[n - 1 - at]
            else:
                dead.add(at)
                token = shorter[out.pop()]
                at -= length[last]
                last = out[-1] if out else -1


class Slots(dict):
    """Pieces of text with a slot each, numbered as they come; those seen once go when memory is full."""

    def __init__(self):
        super().__init__()
        self.hits, self.held = np.empty(0, np.int64), 0

    def seen(self, slots: np.ndarray) -> np.ndarray:
        hits = np.bincount(slots, minlength=len(self))
        hits[:len(self.hits)] += self.hits
        self.hits = hits
        return slots

    def survivors(self) -> np.ndarray:
        """The slots seen more than once, or none if they are most; they are numbered anew in their order."""
        keep = np.flatnonzero(self.hits > 1)
        if len(keep) * 2 > len(self):
            keep = keep[:0]
        pieces, held = list(self), self.held * len(keep) // max(1, len(self))
        self.clear()
        self.update((pieces[k], i) for i, k in enumerate(keep.tolist()))
        self.hits, self.held = self.hits[keep] // 2, held
        return keep


class Encoded(Slots):
    """Slots with token ids each, in flat arrays."""

    def __init__(self):
        super().__init__()
        self.ids, self.ends, self.n_ids = np.empty(1 << 16, np.int32), np.zeros(1 << 14, np.int64), 0

    def add(self, ids: np.ndarray, size: np.ndarray) -> None:
        """The ids of the newest slots; the flat arrays grow by doubling."""
        n, to = len(self) + 1, self.n_ids + len(ids)
        self.ids = _grown(self.ids, to)
        self.ids[self.n_ids:to] = ids
        self.ends = _grown(self.ends, n)
        self.ends[n - len(size):n] = self.n_ids + np.cumsum(size)
        self.n_ids = to

    def of(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of slots one after another, and the number of each."""
        size = self.ends[slots + 1] - self.ends[slots]
        return self.ids[runs(self.ends[slots], size)], size


class Words(Encoded):
    """Encoded pre-tokens, by the signs of their bytes.  Slot 0 has no ids: it is the border between pieces."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.byte = {ord(s): b for b, s in enumerate(_byte_signs())}
        self.begin()

    def begin(self) -> None:
        """Forget all but the borders and the special tokens."""
        self.clear()
        self.held = self.n_ids = 0
        self.update({"\n": 0, _BORDER_SIGNS: 0})
        special = self.vocabulary.special
        # A key for each slot: borders share one, so their second key stands for an empty slot.
        self.update({"\n" + s: 2 + k for k, s in enumerate(special)})
        self.add(np.array([*special.values()], np.int32), np.array([0, 0, *[1] * len(special)]))
        self.new_ids: list[int] = []
        self.new_sizes: list[int] = []

    def __missing__(self, signs: str) -> int:
        plain = signs.removeprefix(" ")
        ids = self.vocabulary.word(plain if plain.isascii() else plain.translate(self.byte))
        self.new_ids += ids
        self.new_sizes.append(len(ids))
        self.held += len(signs) + 64
        slot = self[signs] = len(self)
        return slot

    def slots(self, signs: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.__getitem__, signs), np.int64, len(signs))
        if self.new_sizes:
            self.add(np.array(self.new_ids, np.int32), np.array(self.new_sizes, np.int64))
            self.new_ids, self.new_sizes = [], []
        return found


class Pieces(Encoded):
    """Encoded pieces of text between white space."""

    _PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+|\n", re.ASCII)

    def __init__(self, text: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.vocabulary = Vocabulary(text)
        self.words = Words(self.vocabulary)
        empty = {**json.loads(text), "added_tokens": [], "model": {"type": "BPE", "vocab": {}, "merges": []}}
        library = Tokenizer.from_str(json.dumps(empty))
        self.normal, self.pre = library.normalizer, library.pre_tokenizer
        self.special = re.compile("(" + "|".join(map(re.escape, self.vocabulary.special)) + ")") if self.vocabulary.special else None
        self.new: list[str] = []

    def bound(self) -> None:
        """Forget pieces once they are many; called between texts only."""
        if self.held > KEPT or self.n_ids > KEPT >> 3:
            keep = self.survivors()
            self.ids, size = self.of(keep)
            self.ends = np.concatenate(([0], np.cumsum(size)))
            self.n_ids = len(self.ids)
        if self.words.held > KEPT_WORDS:
            self.words.begin()

    def __missing__(self, piece: bytes) -> int:
        self.new.append(piece.decode("utf-8"))
        self.held += len(piece) + 64
        slot = self[piece] = len(self)
        return slot

    def _signs(self, text: str) -> list[str]:
        return [w for w, _ in self.pre.pre_tokenize_str(self.normal.normalize_str(text))]

    def _special_signs(self, piece: str) -> list[str]:
        """Keys of ``words`` for a piece with special tokens or the character that borders are made of."""
        found: list[str] = []
        for k, part in enumerate(self.special.split(piece) if self.special else [piece]):
            found += ["\n" + part] if k % 2 else [" " + w for w in self._signs(part)] if part else []
        return found

    def _settle(self) -> None:
        """Encode the new pieces: all that are ASCII at once, the others many at once, and one by
        one those that hold special tokens or could be taken for a border."""
        new, self.new = self.new, []
        alone = [bool(self.special and self.special.search(p)) or _BORDER in p for p in new]
        kinds = [[], [], []]
        for i, p in enumerate(new):
            kinds[2 if alone[i] else 0 if p.isascii() else 1].append(i)
        signs = self._PLAIN.findall("".join(new[i] + "\n" for i in kinds[0]).lower())
        for low in range(0, len(kinds[1]), _AT_ONCE):
            signs += self._signs("".join(f"{new[i]}\n{_BORDER}\n" for i in kinds[1][low:low + _AT_ONCE]))
        for i in kinds[2]:
            signs += [*self._special_signs(new[i]), "\n"]
        slots = self.words.slots(signs)
        ids, size = self.words.of(slots)
        # The ids of each piece, from the order of the kinds to that of the slots.
        stop = np.cumsum(size)[slots == 0]
        place = np.argsort(np.array([*kinds[0], *kinds[1], *kinds[2]], np.int64))
        start = np.concatenate(([0], stop))[:-1][place]
        size = stop[place] - start
        self.add(ids[runs(start, size)], size)

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and the number of each."""
        self.bound()
        cut = [t.split() if t else [] for t in texts]
        number = np.array([len(cs) for cs in cut], np.int64)
        slots = np.fromiter(map(self.__getitem__, chain.from_iterable(cut)), np.int64, int(number.sum()))
        if self.new:
            self._settle()
        self.seen(slots)
        ids, size = self.of(slots)
        owner = np.repeat(np.arange(len(texts)), number)
        return ids, np.bincount(owner, weights=size, minlength=len(texts)).astype(np.int64)


def _grown(column: np.ndarray, size: int) -> np.ndarray:
    return column if size <= len(column) else np.concatenate((column, np.zeros(max(size, 2 * len(column)) - len(column), column.dtype)))


def runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices start, start+1, ... of each run, one run after another."""
    first = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - first, size)


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, column: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``, or all) with the token ids of a text column (``ids``) and their number (``n_tokens``)."""
    on_executors(docs.sparkSession)
    text = _read(vocabulary)
    columns = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{column}`").cast("binary").alias("raw"))
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())])

    def run(parts):
        pieces = Pieces(text)
        for batch in parts:
            raw = batch.column(1)
            for first, last in ranges(pc.fill_null(pc.binary_length(raw), 0).to_numpy(zero_copy_only=False)):
                ids, count = pieces.encode(raw.slice(first, last - first).to_pylist())
                offsets = pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.array(count)],
                    names=["row", "ids", "n_tokens"])

    named = [F.col(c).alias(unused(c, columns)) for c in ("ids", "n_tokens")]
    return rows.mapInArrow(run, schema).select("row.*", *named)


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY, column: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the tokens of the ids, joined by one space."""
    on_executors(encoded.sparkSession)
    shown = [(s + " ").encode("utf-8") for s in Vocabulary(_read(vocabulary)).shown]
    table = np.frombuffer(b"".join(shown), np.uint8)
    start = np.concatenate(([0], np.cumsum([len(s) for s in shown])))
    rows = packed(encoded, F.col(f"`{column}`").alias("ids"))
    schema = T.StructType([rows.schema["row"], T.StructField("decoded", T.StringType())])

    def run(parts):
        for batch in parts:
            sizes = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for first, last in ranges(sizes, 1 << 18):
                lists = batch.column(1).slice(first, last - first)
                count = sizes[first:last].astype(np.int64)
                ids = lists.flatten().to_numpy().astype(np.int64)
                size = start[ids + 1] - start[ids]
                # the space behind a text's last token goes
                size[(np.cumsum(count) - 1)[count > 0]] -= 1
                data = table[runs(start[ids], size)]
                stop = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(count)))]
                plain = pa.StringArray.from_buffers(last - first, pa.py_buffer(stop.astype(np.int32)), pa.py_buffer(data.tobytes()))
                if lists.null_count:
                    plain = pc.if_else(lists.is_valid(), plain, None)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), plain], names=["row", "decoded"])

    return rows.mapInArrow(run, schema).select("row.*", F.col("decoded").alias(unused("decoded", encoded.columns)))


def report(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Number of tokens of each document, and digests of its ids and of their decoding."""
    done = decode(encode(docs.select("doc_id", "text"), vocabulary, keep=["doc_id"]), vocabulary)
    return done.select("doc_id", "n_tokens", F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
