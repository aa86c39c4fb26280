"""Sampled SentencePiece segmentation and lossless decoding (operator 5).

A text, with the usual one space in front, falls into stretches that begin at each run of spaces, at
line ends, and after letters at marks that the vocabulary never joins to one; no piece crosses these, so the lattice of all segmentations is a product of one
small lattice per stretch.  For every distinct stretch the forward pass sums the weights of
all segmentations up to each position (filtering); from the end, each step then draws one of
the pieces that end there in proportion to the sums before it (backward sampling).  The draw
at a position depends on the row key and the position alone, through integer hashes and
cumulative weights on a grid of 2**24, so the same row is always cut the same way, however
rows are batched.

Pieces weigh ``-alpha * log(rank + 10)``, ranks being the order of the vocabulary's merges.
Characters outside the vocabulary become byte pieces; so does a literal U+2581, which keeps
decoding lossless: pieces spelled out, less the first space, are the text.

The vocabulary file's path is a parameter; the driver reads it and sends the tables along.
Edge cases: null text gives null pieces and a null decoding; empty text is the single space
piece and decodes to empty text; a null row key is a key like others; repeated rows are cut
alike; other columns pass through (a new column whose name is taken gets an underscore).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import on_executors, packed, unused
from .hashing import mix, ranges, text_ranges

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
GRID = 24
_SHORT = 8
_MOST_EDGES = 4_000_000
_NEW_CHARS = 1 << 16


def _stretches(plain: list[str]) -> str:
    """A pattern for stretches that no piece crosses: they begin at spaces, at line ends, and
    after a Latin letter at marks that no piece holds after such a letter."""
    letter = "A-Za-z\u00c0-\u024f"
    joined = set(re.findall(rf"(?<=[{letter}])[!-/:-@\[-`{{-~]", "\n".join(plain)))
    marks = "".join(re.escape(c) for c in "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~\\" if c not in joined)
    on = rf"[{letter}]*(?:[^{letter} \n{marks}][^{letter} \n]*[{letter}]*)*"
    return rf" +[^{letter} \n]*{on}|[^{letter} \n]+{on}|[{letter}]+{on}|\n"


class Vocabulary:
    """Pieces as a trie in sorted arrays, their weights, and the bytes they spell."""

    def __init__(self, path: str = MODEL, alpha: float = 1.0):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.bytes = np.full(256, -1, np.int32)
        self.spelled: list[bytes] = [b""] * self.size
        rank = np.zeros(self.size)
        steps: dict[tuple[int, int], int] = {}
        at: list[int] = [-1]
        plains: list[str] = []
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[1:-1], 16)] = i
                self.spelled[i] = bytes([int(piece[1:-1], 16)])
                continue
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or "▁" in piece.lstrip("▁") or "\n" in piece:
                continue
            plain = piece.replace("▁", " ")
            plains.append(plain)
            self.spelled[i] = plain.encode("utf-8")
            rank[i] = max(0.0, -model.get_score(i))
            node = 0
            for ch in plain:
                node = steps.setdefault((node, ord(ch)), len(at))
                if node == len(at):
                    at.append(-1)
            at[node] = i
        self.stretch = re.compile(_stretches(plains))
        self.weight = -alpha * np.log(rank + 10.0)
        self.byte_weight = -alpha * float(np.log(self.size))
        key = np.array([(n << 21) | c for n, c in steps], np.int64)
        order = np.argsort(key)
        self.key, self.next = key[order], np.array(list(steps.values()), np.int64)[order]
        self.at = np.array(at, np.int64)
        self.longest = max((len(s.decode("utf-8", "replace")) for s in self.spelled), default=1)

    def spelling(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all pieces one after another, and where each begins."""
        return (np.frombuffer(b"".join(self.spelled), np.uint8),
                np.concatenate(([0], np.cumsum([len(s) for s in self.spelled]))))


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices start, start+1, ... of each run, one run after another."""
    first = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start - first, size)


class _Column:
    """A numpy column that grows by doubling."""

    def __init__(self, kind):
        self.data, self.size = np.empty(1 << 16, kind), 0

    def extend(self, more: np.ndarray) -> None:
        need = self.size + len(more)
        if need > len(self.data):
            self.data = np.concatenate((self.data[:self.size], np.empty(max(need, 2 * len(self.data)) - self.size, self.data.dtype)))
        self.data[self.size:need] = more
        self.size = need


class Lattices:
    """Lattices of distinct stretches, ready for sampling; grows as new ones come.

    Edges are kept by the position where they end, longest first, with running chances on the
    grid: ``first[node]`` to ``first[node + 1]`` in ``grid``, ``before`` and ``piece``.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.odd: dict[int, int] = {}
        self.odd_bytes: list[list[int]] = []
        self.base, self.length, self.first = (_Column(np.int64) for _ in range(3))
        self.grid, self.piece, self.back = _Column(np.int32), _Column(np.int32), _Column(np.int8)
        self.nodes = self.edges = 0

    def add(self, stretches: list[str]) -> None:
        new = list(set(stretches).difference(self.slot))
        if not new:
            return
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        for group in (np.flatnonzero(sizes <= _SHORT), np.flatnonzero(sizes > _SHORT)):  # narrow tables for short ones
            for low, high in ranges(sizes[group], _NEW_CHARS):  # the tables are as wide as the longest piece
                self._add([new[i] for i in group[low:high].tolist()])

    def _add(self, new: list[str]) -> None:
        self.slot.update(zip(new, range(len(self.slot), len(self.slot) + len(new))))
        v = self.v
        code = np.frombuffer("".join(new).encode("utf-32-le"), np.uint32).astype(np.int64)
        length = np.fromiter(map(len, new), np.int64, len(new))
        base = np.cumsum(length + 1) - length - 1
        offset = _runs(np.zeros(len(new), np.int64), length)
        node = np.repeat(base, length) + offset
        left = np.repeat(length, length) - offset
        count = int(length.sum() + len(length))
        widest = min(v.longest, int(length.max()))
        weight = np.full((count, widest), -np.inf)
        piece = np.zeros((count, widest), np.int32)
        alive, state = np.arange(len(code)), np.zeros(len(code), np.int64)
        for size in range(1, widest + 1):
            fit = left[alive] >= size
            alive, state = alive[fit], state[fit]
            if not len(alive):
                break
            wanted = (state << 21) | code[alive + size - 1]
            found = np.minimum(np.searchsorted(v.key, wanted), len(v.key) - 1)
            ok = v.key[found] == wanted
            alive, state = alive[ok], v.next[found[ok]]
            ids = v.at[state]
            has = ids >= 0
            ends = node[alive[has]] + size
            weight[ends, size - 1] = v.weight[ids[has]]
            piece[ends, size - 1] = ids[has]
        bare = np.flatnonzero(np.isneginf(weight[node + 1, 0]))
        for c in np.unique(code[bare]).tolist():
            if c not in self.odd:
                self.odd[c] = v.size + len(self.odd_bytes)
                self.odd_bytes.append([int(v.bytes[b]) for b in chr(c).encode("utf-8")])
        odd = np.fromiter(map(self.odd.__getitem__, code[bare].tolist()), np.int64, len(bare))
        bytes_of = np.array([len(b) for b in self.odd_bytes] or [0])
        weight[node[bare] + 1, 0] = v.byte_weight * bytes_of[odd - v.size] if len(bare) else 0
        piece[node[bare] + 1, 0] = odd
        chance = self._filter(weight, node, offset, count)
        self._keep(chance[:, ::-1], piece[:, ::-1], base, length)

    def _filter(self, weight, node, offset, count) -> np.ndarray:
        """The forward pass over all new stretches at once: chances of the pieces that end at a node."""
        total = np.zeros(count)
        chance = np.zeros_like(weight)
        by = np.argsort(offset, kind="stable")
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(offset[by])) + 1, [len(by)]))
        size = np.arange(1, weight.shape[1] + 1)
        for at, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
            wide = min(at + 1, len(size))
            ends = node[by[low:high]] + 1
            value = weight[ends, :wide] + total[ends[:, None] - size[:wide]]
            top = value.max(axis=1)
            part = np.exp(value - top[:, None])
            whole = part.sum(axis=1)
            total[ends] = top + np.log(whole)
            chance[ends, :wide] = part / whole[:, None]
        return chance

    def _keep(self, chance, piece, base, length) -> None:
        here = chance > 0
        grid = np.minimum(np.rint(np.cumsum(chance, axis=1) * (1 << GRID)), 1 << GRID).astype(np.int32)
        number = here.sum(axis=1)
        full = np.flatnonzero(number)
        last = chance.shape[1] - 1 - np.argmax(here[full, ::-1], axis=1)
        grid[full, last] = 1 << GRID
        size = np.broadcast_to(np.arange(chance.shape[1], 0, -1, dtype=np.int8), chance.shape)
        first = self.edges + np.cumsum(number) - number
        for column, more in ((self.first, first), (self.grid, grid[here]), (self.back, size[here]), (self.piece, piece[here]),
                             (self.base, base + self.nodes), (self.length, length)):
            column.extend(more)
        self.nodes += len(chance)
        self.edges += int(number.sum())

    def sample(self, stretches: list[str], seed: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all stretches and their number in each; ``seed`` is the row's, ``at`` the place in it."""
        self.add(stretches)
        slot = np.fromiter(map(self.slot.__getitem__, stretches), np.int64, len(stretches))
        here, base = self.length.data[slot], self.base.data[slot]
        first, grid, pieces, back = self.first.data, self.grid.data, self.piece.data, self.back.data
        count = np.zeros(len(slot), np.int64)
        live = np.flatnonzero(here > 0)
        steps = []
        while len(live):
            left = here[live]
            draw = mix(seed[live] + (at[live] + left).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            draw = (draw >> np.uint64(64 - GRID)).astype(np.int32)
            edge = first[base[live] + left]
            on = np.flatnonzero(grid[edge] <= draw)
            while len(on):
                edge[on] += 1
                on = on[grid[edge[on]] <= draw[on]]
            steps.append((live, pieces[edge]))
            left = left - back[edge]
            here[live] = left
            count[live] += 1
            live = live[left > 0]
        last = np.cumsum(count) - 1
        ids = np.empty(int(count.sum()), np.int32)
        for k, (who, piece) in enumerate(steps):
            ids[last[who] - k] = piece
        if self.odd_bytes and len(ids) and ids.max() >= self.v.size:
            ids, count = self._bytes(ids, count)
        return ids, count

    def _bytes(self, ids, count):
        """Spell characters outside the vocabulary as byte pieces."""
        table = np.array([x for b in self.odd_bytes for x in b], np.int32)
        sizes = np.array([len(b) for b in self.odd_bytes])
        starts = np.cumsum(sizes) - sizes
        odd = ids >= self.v.size
        which = np.where(odd, ids - self.v.size, 0)
        size = np.where(odd, sizes[which], 1)
        out = np.repeat(ids, size)
        out[np.repeat(odd, size)] = table[_runs(starts[which[odd]], sizes[which[odd]])]
        owner = np.repeat(np.arange(len(count)), count)
        return out, np.bincount(owner, weights=size, minlength=len(count)).astype(np.int64)


def encode_texts(texts: list[str], keys: np.ndarray, lattices: Lattices, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sampled piece ids of all texts one after another, and the number of each."""
    if lattices.edges > _MOST_EDGES:
        lattices.clear()
    found = [lattices.v.stretch.findall(" " + t) for t in texts]
    number = np.array([len(f) for f in found])
    flat = [w for f in found for w in f]
    size = np.fromiter(map(len, flat), np.int64, len(flat))
    owner = np.repeat(np.arange(len(texts)), number)
    before = np.cumsum(size) - size
    at = before - before[np.cumsum(number) - number][owner] if len(flat) else before
    rows = mix(keys.view(np.uint64) ^ mix(np.uint64(seed)))
    ids, count = lattices.sample(flat, rows[owner], at)
    return ids, np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64)


def spell(ids: np.ndarray, count: np.ndarray, spelling) -> list[bytes]:
    """The texts that runs of piece ids spell, less the space in front."""
    table, start = spelling
    size = start[ids + 1] - start[ids]
    data = table[_runs(start[ids], size)].tobytes()
    ends = np.cumsum(size)
    stop = np.concatenate(([0], ends))[np.cumsum(count)]
    first = np.concatenate(([0], stop[:-1]))
    return [data[a + 1:b] for a, b in zip(first.tolist(), stop.tolist())]


def encode(docs: DataFrame, key: str = "doc_id", model: str = MODEL, alpha: float = 1.0, seed: int = 5) -> DataFrame:
    """``docs`` with ``pieces`` (ids), ``n_pieces`` and ``lossless`` (they spell the text again)."""
    on_executors(docs.sparkSession)
    vocabulary = Vocabulary(model, alpha)
    rows = packed(docs, F.col(f"`{key}`").cast("long").alias("key"))
    schema = T.StructType([rows.schema["row"], T.StructField("pieces", T.ArrayType(T.IntegerType())),
                           T.StructField("n_pieces", T.LongType()), T.StructField("lossless", T.BooleanType())])
    at = docs.columns.index("text")

    def run(parts):
        lattices, spelling = Lattices(vocabulary), vocabulary.spelling()
        for batch in parts:
            keys = batch.column(1).fill_null(-(2**63)).to_numpy()
            for first, last, texts in text_ranges(batch.column(0).field(at), 1 << 19):
                own = [t or "" for t in texts]
                here = np.array([t is not None for t in texts])
                ids, count = encode_texts(own, keys[first:last].copy(), lattices, seed)
                back = spell(ids, count, spelling)
                same = [b == t.encode("utf-8") for b, t in zip(back, own)]
                offsets = pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32())
                pieces = pa.ListArray.from_arrays(offsets, pa.array(ids))
                if not here.all():
                    pieces = pieces.take(pa.array(np.where(here, np.arange(len(own)), -1), pa.int64(), mask=~here))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pieces, pa.array(count, pa.int64(), mask=~here),
                     pa.array(same, pa.bool_(), mask=~here)], names=["row", "pieces", "n_pieces", "lossless"])

    named = [F.col(c).alias(unused(c, docs.columns)) for c in ("pieces", "n_pieces", "lossless")]
    return rows.mapInArrow(run, schema).select("row.*", *named)


def decode(encoded: DataFrame, model: str = MODEL, column: str = "pieces") -> DataFrame:
    """``encoded`` with ``decoded``: the text that the piece ids spell."""
    on_executors(encoded.sparkSession)
    spelling = Vocabulary(model).spelling()
    rows = packed(encoded)
    schema = T.StructType([rows.schema["row"], T.StructField("decoded", T.StringType())])
    at = encoded.columns.index(column)

    def run(parts):
        for batch in parts:
            lists = batch.column(0).field(at)
            count = np.array([0 if n is None else n for n in pc.list_value_length(lists).to_pylist()])
            texts = spell(lists.flatten().to_numpy().astype(np.int64), count, spelling) if len(lists) else []
            known = lists.is_valid().to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t.decode("utf-8") if k else None for t, k in zip(texts, known)], pa.string())],
                names=["row", "decoded"])

    return rows.mapInArrow(run, schema).select("row.*", F.col("decoded").alias(unused("decoded", encoded.columns)))
