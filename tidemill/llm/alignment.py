"""Links between the tokens of two tokenizers through their bytes (operator 13).

Vocabulary A is a byte-level file of merges, B a model of pieces; both encode the text with one
space in front.  A token stands in an incidence matrix as a row over the bytes it covers, kept as
compressed rows (where each row begins, and its columns) that are built here by hand.  Products
of such matrices link tokens, row by row (Gustavson): each entry of a row of A picks a row of the
transposed B, and the picked rows are added up.

* ``overlap``: A·Bᵀ over all bytes; the value is the number of shared bytes.
* ``group``: token-group incidences, A's times B's transposed; groups end where tokens of both end.
* ``ends``: incidences of tokens with their last byte: the tokens that end together.

Neither vocabulary joins a word to a space behind it, so a text is a row of pieces, each beginning
with its space, and its matrices are blocks along the diagonal; the blocks of distinct pieces are
multiplied once a task, while they are in a bounded memory.

Counts of linked ids come from all rows.  The ids' counts that most links meet (a number of them
that is a parameter) are sent to all tasks; links that meet others are joined to their counts.

Vocabulary paths are parameters.  Edge cases: null and empty texts, and texts that either
vocabulary doesn't spell again byte by byte (a literal U+2581), have no tokens, groups or links;
strings of special tokens are plain text; null ids, ties and repeated rows are rows like others;
a new column whose name is taken gets an underscore; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import Slots, _byte_signs, runs
from .common import cut, on_executors, unused
from .hashing import ranges

BYTES_FILE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: The most id pairs whose counts are sent to all tasks (16 MB).
SENT_PAIRS = 1 << 20
#: What a task keeps of encoded pieces, in links and in bytes.
KEPT = 1 << 22
#: How many pieces B encodes at once: the work on one symbol grows with the text it stands in.
AT_ONCE = 64
_CUT, _WIDE = re.compile(r"(?<=\S)(?= )"), re.compile(r"\s ")


class Rows:
    """A sparse matrix as compressed rows: row ``i`` has the columns ``at[begin[i]:begin[i + 1]]``."""

    def __init__(self, begin: np.ndarray, at: np.ndarray, width: int, value: np.ndarray | None = None):
        self.begin, self.at, self.width = begin, at, width
        self.value = np.ones(len(at), np.int64) if value is None else value

    @classmethod
    def spans(cls, ends: np.ndarray, width: int) -> "Rows":
        """Each row covers the columns from the end of the row before it to its own."""
        return cls(np.concatenate(([0], ends)), np.arange(width), width)

    @classmethod
    def single(cls, at: np.ndarray, width: int) -> "Rows":
        """Each row has one column."""
        return cls(np.arange(len(at) + 1), at, width)

    @property
    def height(self) -> int:
        return len(self.begin) - 1

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(self.height), np.diff(self.begin))

    def transposed(self) -> "Rows":
        order = np.argsort(self.at, kind="stable")
        begin = np.concatenate(([0], np.cumsum(np.bincount(self.at, minlength=self.width))))
        return Rows(begin, self.owners()[order], self.height, self.value[order])

    def times(self, other: "Rows", block: int = 1 << 20) -> "Rows":
        """Gustavson's product, for as many rows at a time as pick about ``block`` entries."""
        picks = np.diff(other.begin)[self.at]
        work = np.concatenate(([0], np.cumsum(picks)))[self.begin]
        counts, ats, values = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        low = 0
        while low < self.height:
            high = max(low + 1, int(np.searchsorted(work, work[low] + block, "right")) - 1)
            entry = slice(self.begin[low], self.begin[high])
            row = np.repeat(np.arange(high - low), np.diff(self.begin[low:high + 1]))
            size = picks[entry]
            there = runs(other.begin[self.at[entry]], size)
            key = np.repeat(row, size) * other.width + other.at[there]
            value = np.repeat(self.value[entry], size) * other.value[there]
            key, place = np.unique(key, return_inverse=True)
            counts.append(np.bincount(key // other.width, minlength=high - low) if len(key) else np.zeros(high - low, np.int64))
            ats.append(key % other.width if len(key) else key)
            values.append(np.bincount(place, weights=value, minlength=len(key)).astype(np.int64))
            low = high
        return Rows(np.concatenate(([0], np.cumsum(np.concatenate(counts)))), np.concatenate(ats), other.width, np.concatenate(values))


def linked(a_ends: np.ndarray, b_ends: np.ndarray, width: int, kind: str = "ends") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A's tokens, B's tokens, values) of all links between tokens that end at these bytes."""
    if kind == "overlap":
        a, b = Rows.spans(a_ends, width), Rows.spans(b_ends, width)
    elif kind == "ends":
        a, b = Rows.single(a_ends - 1, width), Rows.single(b_ends - 1, width)
    else:
        shared = linked(a_ends, b_ends, width)
        ends = a_ends[shared[0]]
        a, b = (Rows.single(np.searchsorted(ends, e), len(ends)) for e in (a_ends, b_ends))
    product = a.times(b.transposed())
    return product.owners(), product.at, product.value


class Pair:
    """The two tokenizers, with the bytes that each of their ids spells."""

    def __init__(self, a_file: str = BYTES_FILE, b_file: str = PIECES_FILE):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        byte = {s: b for b, s in enumerate(_byte_signs())}
        self.a_spelled = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        for sign, i in self.a.get_vocab(with_added_tokens=True).items():
            self.a_spelled[i] = sign.encode() if sign in special else bytes(byte[s] for s in sign)
        self.b_spelled = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_spelled.append(bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode("utf-8"))
        self.b_width = len(self.b_spelled)
        self.width = self.b_width * len(self.a_spelled)
        self.a_size, self.b_size = (np.array([len(x) for x in s], np.int64) for s in (self.a_spelled, self.b_spelled))
        # Ids as they are shown before another of their group, before B's, before the next group, and last.
        self.n_ids = max(len(self.a_spelled), self.b_width)
        digits = pa.array(range(self.n_ids)).cast(pa.string())
        self.signs = pa.concat_arrays([pc.binary_join_element_wise(digits, sign, "") for sign in (",", "|", ";", "")])
        # A text that ends in one space has that space as its last piece; alone, B takes it for no text.
        self.b_space = np.array(self.b.encode("x ")[len(self.b.encode("x")):], np.int64)
        # Texts may be cut between a word and a space only if no piece goes over that place.
        self.cuts = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b_width))

    def pieces(self, text: str) -> list[str]:
        """The text with a space in front, cut where tokens of both always end; of each piece, what follows its first space."""
        if not self.cuts:
            return [text]
        if text[:1] == " " or _WIDE.search(text):
            return [p[1:] for p in _CUT.split(" " + text)]
        return text.split(" ")

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bool]]:
        """(A's ids, B's ids, how many of each a piece has, whether both spell it) of pieces one after another."""
        whole = " " + " ".join(pieces)
        ends = np.cumsum([*map(len, pieces)] if whole.isascii() else [len(p.encode("utf-8")) for p in pieces]) + np.arange(1, len(pieces) + 1)
        parts = [" ".join(pieces[k:k + AT_ONCE]) for k in range(0, len(pieces), AT_ONCE)]
        ids = [np.array(self.a.encode_batch_fast([whole], add_special_tokens=False)[0].ids, np.int64),
               self.b_space if whole == " " else np.array([*chain.from_iterable(self.b.encode(parts, num_threads=1))], np.int64)]
        counts = []
        for own, size, spelled in zip(ids, (self.a_size, self.b_size), (self.a_spelled, self.b_spelled)):
            stops = np.cumsum(size[own])
            at = np.searchsorted(stops, ends)
            if b"".join(map(spelled.__getitem__, own.tolist())) != whole.encode("utf-8") or (stops[at] != ends).any():
                break
            counts.append(np.diff(at + 1, prepend=0))
        if len(counts) == 2:
            return *ids, *counts, [True] * len(pieces)
        if len(pieces) > 1:  # some piece isn't spelled again, or has no border to the next: find it by halves
            half = len(pieces) // 2
            one, two = self.encode(pieces[:half]), self.encode(pieces[half:])
            return *(np.concatenate((x, y)) for x, y in zip(one[:4], two[:4])), one[4] + two[4]
        none = np.empty(0, np.int64)
        return none, none, np.zeros(1, np.int64), np.zeros(1, np.int64), [False]


class Blocks(Slots):
    """Aligned pieces: for each a slot, with counts and links of ids in flat arrays."""

    def __init__(self, pair: Pair, kind: str = "ends"):
        super().__init__()
        self.pair, self.kind = pair, kind
        self.n = np.zeros((0, 4), np.int64)  # of each slot: tokens of A and B, groups, whether it's spelled again
        self.shown = pa.array([], pa.string())  # the groups of each: ids of A, ``|``, ids of B; ``;`` between groups
        self.links, self.ends = np.empty(0, np.int64), np.zeros(1, np.int64)
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        slot = self[piece] = len(self)
        return slot

    def slots(self, pieces: list[str]) -> np.ndarray:
        """The slots of pieces; those that are new are aligned at once, their matrices being one of blocks."""
        if len(self.links) > KEPT or self.held > KEPT * 4:
            keep = self.survivors()
            size = self.ends[keep + 1] - self.ends[keep]
            self.n, self.shown = self.n[keep], self.shown.take(pa.array(keep))
            self.links = self.links[runs(self.ends[keep], size)]
            self.ends = np.concatenate(([0], np.cumsum(size)))
        slots = np.fromiter(map(self.__getitem__, pieces), np.int64, len(pieces))
        if self.new:
            self._settle()
        return self.seen(slots)

    def _settle(self) -> None:
        new, self.new = self.new, []
        # Pieces that end in white space, at the end of a text, have no sure border to the next one.
        loose = np.array([not p or p[-1].isspace() for p in new])
        order = np.argsort(loose, kind="stable")
        firm = [new[k] for k in order[:len(new) - int(loose.sum())].tolist()]
        groups = [firm[first:last] for first, last in ranges(np.array([len(p) for p in firm], np.int64))] if firm else []
        found = [self._aligned(g) for g in [*groups, *([new[k]] for k in order[len(firm):].tolist())]]
        n, links, size = (np.concatenate([f[k] for f in found]) for k in (0, 2, 3))
        shown = pa.concat_arrays([f[1] for f in found])
        if loose.any():  # from the order of work to that of the slots
            place = np.argsort(order)
            n, shown, links, size = n[place], shown.take(pa.array(place)), links[runs((np.cumsum(size) - size)[place], size[place])], size[place]
        self.n, self.links = np.concatenate((self.n, n)), np.concatenate((self.links, links))
        self.shown = pa.concat_arrays([self.shown, shown])
        self.ends = np.concatenate((self.ends, self.ends[-1] + np.cumsum(size)))
        self.held += sum(f[4] for f in found) + 64 * len(new)

    def _aligned(self, new: list[str]) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray, int]:
        """(``n``, groups, links, how many links of each, bytes in all) of pieces."""
        pair = self.pair
        a_ids, b_ids, n_a, n_b, spelled = pair.encode(new)
        a_ends, b_ends = np.cumsum(pair.a_size[a_ids]), np.cumsum(pair.b_size[b_ids])
        width = int(a_ends[-1]) if len(a_ends) else 0
        i, j, _ = linked(a_ends, b_ends, width, self.kind)
        owner = np.repeat(np.arange(len(new)), n_a)
        last_a, last_b, _ = linked(a_ends, b_ends, width) if self.kind != "ends" else (i, j, None)
        n_groups = np.bincount(owner[last_a], minlength=len(new))
        n = np.stack([n_a, n_b, n_groups, np.array(spelled, np.int64)], 1)
        return (n, _shown(pair, a_ids, b_ids, last_a, last_b, n_a + n_b), a_ids[i] * pair.b_width + b_ids[j],
                np.bincount(owner[i], minlength=len(new)), width)


def _shown(pair: Pair, a_ids, b_ids, last_a, last_b, n_tokens) -> pa.Array:
    """The groups of each piece, whose last tokens of A and B and numbers of tokens are given."""
    before_a, before_b = (np.concatenate(([0], last + 1)) for last in (last_a, last_b))
    # Of each group A's tokens stand before B's.
    at_a = np.arange(len(a_ids)) + np.repeat(before_b[:-1], np.diff(before_a))
    at_b = np.arange(len(b_ids)) + np.repeat(before_a[1:], np.diff(before_b))
    sign = np.empty(len(a_ids) + len(b_ids), np.int64)
    sign[at_a], sign[at_b] = a_ids, b_ids
    sign[at_a[last_a]] += pair.n_ids
    sign[at_b[last_b]] += 2 * pair.n_ids
    ends = np.concatenate(([0], np.cumsum(n_tokens)))
    sign[ends[1:][n_tokens > 0] - 1] += pair.n_ids
    text = pair.signs.take(pa.array(sign))
    _, offsets, data = text.buffers()
    starts = np.frombuffer(offsets, np.int32)[text.offset:][ends] if len(sign) else np.zeros(len(ends), np.int32)
    return pa.StringArray.from_buffers(len(n_tokens), pa.py_buffer(starts), data or pa.py_buffer(b""))


def _tally(row: np.ndarray, link: np.ndarray, width: int, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different links of each row, how often each stands there, and how many there are."""
    key, times = np.unique(row * width + link, return_counts=True)
    return key % width, times.astype(np.int64), np.bincount(key // width, minlength=n)


_FOUND = [T.StructField("n_a", T.LongType()), T.StructField("n_b", T.LongType()), T.StructField("n_groups", T.LongType()),
          T.StructField("n_links", T.LongType()), T.StructField("groups", T.StringType()),
          T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("times", T.ArrayType(T.LongType()))]


def align(docs: DataFrame, kind: str = "ends", column: str = "text", a_file: str = BYTES_FILE, b_file: str = PIECES_FILE,
          keep: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``, or all) with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups`` (ids as ``a1,a2|b1;a3|b2,b3``), and
    the links of the kind by their ids: ``pairs`` (A's id times the size of B's vocabulary plus B's id) and,
    for each, how many ``times`` it is linked."""
    on_executors(docs.sparkSession)
    columns = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{column}`").alias("whole"))

    def run(parts):
        blocks = Blocks(Pair(a_file, b_file), kind)
        for batch in parts:
            column = batch.column(1)
            for first, last in ranges(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)):
                texts = [blocks.pair.pieces(t) if t else [] for t in column.slice(first, last - first).to_pylist()]
                size = np.array([len(t) for t in texts], np.int64)
                slots = blocks.slots([p for t in texts for p in t])
                owner = np.repeat(np.arange(len(texts)), size)
                found = blocks.n[slots]
                bad = np.bincount(owner, weights=1 - found[:, 3], minlength=len(texts)) > 0
                keep = ~bad[owner]
                n = [np.bincount(owner[keep], weights=found[keep, k], minlength=len(texts)).astype(np.int64) for k in range(3)]
                begin, ends = blocks.ends[slots[keep]], blocks.ends[slots[keep] + 1]
                n_links = np.bincount(owner[keep], weights=ends - begin, minlength=len(texts)).astype(np.int64)
                own = pa.array(np.concatenate(([0], np.cumsum(np.where(bad, 0, size)))), pa.int32())
                shown = pc.binary_join(pa.ListArray.from_arrays(own, blocks.shown.take(pa.array(slots[keep]))), ";")
                pairs, times, different = _tally(np.repeat(np.arange(len(texts)), n_links), blocks.links[runs(begin, ends - begin)],
                                                 blocks.pair.width, len(texts))
                offsets = pa.array(np.concatenate(([0], np.cumsum(different))), pa.int32())
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (pairs, times)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), *map(pa.array, n), pa.array(n_links), shown, *lists],
                    names=["row", *[f.name for f in _FOUND]])

    named = [F.col(f.name).alias(unused(f.name, columns)) for f in _FOUND]
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], *_FOUND])).select("row.*", *named)


def pair_counts(rows: DataFrame, b_width: int, pairs: str = "pairs", times: str = "times") -> DataFrame:
    """(pair, n, best): how many links hold each pair of ids, and whether no pair of its B id has more."""
    each = rows.select(F.explode(F.arrays_zip(pairs, times)).alias("p"))
    counts = cut(each.groupBy(F.col(f"p.{pairs}").alias("pair")).agg(F.sum(f"p.{times}").alias("n")), "pair-counts")
    tops = counts.groupBy((F.col("pair") % b_width).alias("b")).agg(F.max("n").alias("top"))  # a row for each id of B at most
    return cut(counts.join(tops, F.col("pair") % b_width == F.col("b")).select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "pair-best")


def _least_sent(counts: DataFrame, most: int) -> int:
    """The least power of two so that at most ``most`` pairs have that count."""
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("log")).count().orderBy(F.desc("log")).collect()  # 64 rows at most
    least, total = 1 << 62, 0
    for log, n in sizes:
        total += n
        if total > most:
            break
        least = 1 << log
    return least


def score_links(rows: DataFrame, counts: DataFrame, key: str, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """(key, n_best, count_sum) of rows with ``pairs`` and ``times``; a row for each key."""
    least = _least_sent(counts, sent_pairs)
    table = counts.where(F.col("n") >= least).orderBy("pair").toArrow()  # at most sent_pairs rows
    sent = rows.sparkSession.sparkContext.broadcast([table[c].to_numpy() for c in ("pair", "n", "best")])
    schema = T.StructType([rows.schema[key], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType()),
                           T.StructField("rest", T.ArrayType(T.StructType([T.StructField("pair", T.LongType()), T.StructField("times", T.LongType())])))])

    def run(parts):
        pair, n, best = sent.value
        for batch in parts:
            lists = batch.column(1)
            size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(size)), size)
            own, times = lists.flatten().to_numpy(), batch.column(2).flatten().to_numpy()
            at = np.minimum(np.searchsorted(pair, own), max(len(pair) - 1, 0))
            here = pair[at] == own if len(pair) else np.zeros(len(own), bool)
            got = at[here]
            add = lambda w: np.bincount(owner[here], weights=w, minlength=len(size)).astype(np.int64)
            # sums of counts stay exact as floats only below 2**53, so whole numbers are added up
            total = np.zeros(len(size), np.int64)
            np.add.at(total, owner[here], times[here] * n[got])
            left = np.bincount(owner[~here], minlength=len(size))
            rest = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(left))), pa.int32()),
                pa.StructArray.from_arrays([pa.array(own[~here], pa.int64()), pa.array(times[~here], pa.int64())], names=["pair", "times"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(add(times[here] * best[got])), pa.array(total), rest], names=schema.names)

    done = cut(rows.select(key, "pairs", "times").mapInArrow(run, schema), "scored")
    rest = done.select(key, F.explode("rest").alias("r")).join(counts.where(F.col("n") < least), F.col("r.pair") == F.col("pair"))
    more = rest.groupBy(F.col(key).alias("more_key")).agg(F.sum(F.col("r.times") * F.col("best").cast("long")).alias("more_best"),
                                   F.sum(F.col("r.times") * F.col("n")).alias("more_sum"))
    plus = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
    return done.join(more, F.col(key) == F.col("more_key"), "left").select(key, plus("n_best", "more_best"), plus("count_sum", "more_sum"))


def report(docs: DataFrame, sent_pairs: int = SENT_PAIRS, a_file: str = BYTES_FILE, b_file: str = PIECES_FILE) -> DataFrame:
    """Tokens, groups and links of each document, and how common its links are in all documents."""
    found = align(docs.select("doc_id", "text"), "ends", a_file=a_file, b_file=b_file, keep=["doc_id"])
    rows = cut(found.select(
        F.monotonically_increasing_id().alias("key"), "doc_id", "n_a", "n_b", "n_groups", "n_links", "pairs", "times",
        F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")), "aligned")
    import sentencepiece

    counts = pair_counts(rows, sentencepiece.SentencePieceProcessor(model_file=b_file).get_piece_size())
    scores = score_links(rows, counts, "key", sent_pairs).withColumnRenamed("key", "score_key")
    return rows.join(scores, F.col("key") == F.col("score_key")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
