"""Toxicity scores: gradient-boosted trees over dense features, calibrated (operator 3).

The classifier is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``, the smallest
by a hash of ``doc_id``), the one bound of this module; scoring covers every whole text.

* **Lexicon**: words and word beginnings (4 to 6 letters) that occur in toxic sample rows far
  more often than in the others, weighted by log-odds.  For the features of the sample itself
  each fold uses the counts of the other folds, so the trees do not learn from leaked words.
* **Dense features**: lexicon densities, second-person proximity, rates of capitals,
  punctuation, digits, exclamation, obfuscation (a symbol or digit, or a run of those that disguise, inside a word) and
  repeated characters, and the length.
* **Trees and calibration**: ``GBTClassifier`` on all folds but the last, isotonic regression
  of its probabilities on the last; a part that lacks a kind of label gives way to all rows.

Labels, language, source and ``doc_id`` are never inputs of a score.  Edge cases: null text
counts as empty and scores like any other row; several labels of one ``doc_id`` count as
toxic if one is; null labels are not learned from; with no labelled rows of both kinds the
score is the share of toxic rows (0 without rows); columns of ``docs`` other than ``doc_id``
and ``text`` are passed through.
"""

from __future__ import annotations

import math
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, on_executors, packed
from .hashing import text_ranges

SAMPLE_ROWS, FOLDS = 12_000, 4
STEMS = (4, 5, 6)
LEAST_ROWS, LEAST_Z, LEAST_SHARE = 4, 5.0, 0.5
FEATURES = ["_tox_" + f for f in ("chars", "hits", "density", "top", "sum", "kinds", "person", "capitals", "punctuation",
                                  "digits", "exclaim", "obfuscated", "repeats")]

# Second-person words of the languages at hand.
SECOND_PERSON = ("you your yours yourself du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre "
                 "vos ti usted ustedes vosotros vuestro")
# Symbols that stand for letters in disguised words.
DISGUISE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

_PERSON = re.compile(r"\b(?:" + "|".join(SECOND_PERSON.split()) + r")\b")
_LETTERS = re.compile(r"[^\W\d_]{4,}")
_DISGUISED = re.compile(r"[^\W\d_]+(?:[0134578@$!*]+[^\W\d_]+)+")
_PLAIN = str.maketrans(DISGUISE)
_SYMBOLS = np.array([ord(c) for c in [*DISGUISE, "8", "*"]], np.uint32)
_NEAR = 80


def _keys(text: str) -> set[str]:
    """The words of a text and, marked by a star, their beginnings."""
    found = set(_LETTERS.findall(_lowered(text)))
    return found | {w[:k] + "*" for w in found for k in STEMS if len(w) > k}


def _lowered(text: str) -> str:
    """Lower case, with disguised words spelled plainly."""
    low = text.lower()
    return _DISGUISED.sub(lambda m: m.group().translate(_PLAIN).replace("*", ""), low)


def _count_keys(frames):
    """(key, counts of rows by fold, counts of toxic rows by fold), summed within the task."""
    rows: dict[str, list[int]] = {}
    for pdf in frames:
        for text, y, fold in zip(pdf["text"], pdf["y"], pdf["fold"]):
            for key in _keys(text):
                rows.setdefault(key, [0] * (2 * FOLDS))[2 * fold + y] += 1
    import pandas as pd

    keys = list(rows)
    for k in range(0, len(keys), 50_000):
        part = keys[k:k + 50_000]
        yield pd.DataFrame({"key": part} | {f"c{i}": [rows[x][i] for x in part] for i in range(2 * FOLDS)})


def learn_lexicon(sample: DataFrame) -> list[dict[str, float]]:
    """Weights of words and word beginnings: one lexicon without each fold, and the whole one last."""
    counts = [f"c{i}" for i in range(2 * FOLDS)]
    schema = "key string, " + ", ".join(f"{c} long" for c in counts)
    summed = (sample.mapInPandas(_count_keys, schema).groupBy("key").agg(*[F.sum(c).alias(c) for c in counts])
              .where(F.expr("+".join(counts[1::2])) >= LEAST_ROWS))
    totals = {(r["fold"], r["y"]): r["n"] for r in sample.groupBy("fold", "y").agg(F.count("*").alias("n")).collect()}
    lexicons: list[dict[str, float]] = []
    whole = sum(totals.values())
    most_clean = F.expr("+".join(counts[0::2])) <= F.expr("+".join(counts[1::2])) / LEAST_SHARE
    rows = summed.where(most_clean).collect() if whole else []
    for left in [*range(FOLDS), None]:
        of = lambda y: [f for f in range(FOLDS) if f != left]
        clean, toxic = (sum(totals.get((f, y), 0) for f in of(y)) for y in (0, 1))
        share = toxic / max(1, toxic + clean)
        lexicon = {}
        for r in rows:
            t, c = sum(r[2 + 2 * f] for f in of(1)), sum(r[1 + 2 * f] for f in of(0))
            n = t + c
            spread = math.sqrt(max(n * share * (1 - share), 1e-9))
            if t >= LEAST_ROWS and t >= LEAST_SHARE * n and (t - n * share) / spread >= LEAST_Z:
                lexicon[r["key"]] = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        lexicons.append(lexicon)
    return lexicons


def _automaton(lexicon: dict[str, float]):
    found = ahocorasick.Automaton()
    for key, weight in lexicon.items():
        plain = key.rstrip("*")
        old = found.get(plain, None)
        found.add_word(plain, (len(plain), max(weight, old[1]) if old else weight,
                               key.endswith("*") or bool(old and old[2])))
    if len(found):
        found.make_automaton()
    return found


def _hits(lowered: str, lexicon) -> dict[int, tuple[float, str]]:
    """The heaviest entry at each word beginning."""
    found: dict[int, tuple[float, str]] = {}
    if not len(lexicon):
        return found
    for end, (size, weight, stem) in lexicon.iter(lowered):
        start = end - size + 1
        if start and lowered[start - 1].isalpha():
            continue
        if not stem and end + 1 < len(lowered) and lowered[end + 1].isalpha():
            continue
        if start not in found or found[start][0] < weight:
            found[start] = (weight, lowered[start:end + 1])
    return found


def _classes() -> np.ndarray:
    """Per code point of the first planes: 1 lower letter, 2 capital, 3 digit, 4 space, 0 other."""
    table = np.zeros(0x3000, np.uint8)
    for c in range(len(table)):
        ch = chr(c)
        table[c] = 2 if ch.isupper() else 1 if ch.isalpha() else 3 if ch.isdigit() else 4 if ch.isspace() else 0
    return table


_CLASS = _classes()


def dense_features(texts: list[str], lexicon) -> np.ndarray:
    out = np.zeros((len(texts), len(FEATURES)))
    code = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) for t in texts])
    at = np.concatenate(([0], np.cumsum(size + 1)[:-1])).astype(np.int64)
    kind = np.where(code < len(_CLASS), _CLASS[np.minimum(code, len(_CLASS) - 1)], 1)
    letter = (kind == 1) | (kind == 2)
    other = (kind == 0) | (kind == 3)
    inside = np.zeros(len(code), bool)
    inside[1:-1] = other[1:-1] & letter[:-2] & letter[2:]
    symbol = np.concatenate(([False], np.isin(code, _SYMBOLS), [False]))
    begin, end = np.flatnonzero(symbol[1:] & ~symbol[:-1]), np.flatnonzero(symbol[:-1] & ~symbol[1:])
    between = (begin > 0) & (end < len(code))
    between[between] = letter[begin[between] - 1] & letter[end[between]]
    step = np.zeros(len(code) + 1, np.int64)
    step[begin[between]], step[end[between]] = 1, -1
    inside |= np.cumsum(step[:-1]) > 0
    again = np.zeros(len(code), bool)
    again[2:] = (code[2:] == code[1:-1]) & (code[1:-1] == code[:-2])
    length = np.maximum(size, 1)
    for column, flag in ((7, kind == 2), (8, kind == 0), (9, kind == 3), (10, code == ord("!")), (11, inside), (12, again)):
        out[:, column] = np.add.reduceat(flag.astype(np.int32), at) / length if len(texts) else 0
    for i, text in enumerate(texts):
        low = _lowered(text)
        found = _hits(low, lexicon)
        out[i, 0] = math.log1p(len(text))
        if found:
            weights = sorted((w for w, _ in found.values()), reverse=True)
            out[i, 1] = math.log1p(len(weights))
            out[i, 2] = 1000 * len(weights) / (len(text) + 50)
            out[i, 3], out[i, 4] = weights[0], sum(weights[:5])
            out[i, 5] = len({x for _, x in found.values()})
            for start in found:
                low_end = max(0, start - _NEAR)
                for m in _PERSON.finditer(low, low_end, start + _NEAR):
                    out[i, 6] = max(out[i, 6], 1 - abs(m.start() - start) / (_NEAR + 1))
    return out


def _featured(rows: DataFrame, lexicons: list[dict[str, float]], fold: bool = False) -> DataFrame:
    """``rows`` (a struct ``row`` with the text) and the feature columns; with ``fold`` the struct's
    ``fold`` picks the lexicon, else the whole one is used."""
    schema = T.StructType([rows.schema["row"], *[T.StructField(f, T.DoubleType()) for f in FEATURES]])
    names = rows.schema["row"].dataType.fieldNames()
    text_at, fold_at = names.index("text"), names.index("fold") if fold else None

    def run(parts):
        built = {}
        for batch in parts:
            folds = batch.column(0).field(fold_at).to_pylist() if fold else [len(lexicons) - 1] * batch.num_rows
            for first, last, texts in text_ranges(batch.column(0).field(text_at)):
                values = np.zeros((last - first, len(FEATURES)))
                for f in set(folds[first:last]):
                    own = [i for i in range(last - first) if folds[first + i] == f]
                    if f not in built:
                        built[f] = _automaton(lexicons[f])
                    values[own] = dense_features([texts[i] or "" for i in own], built[f])
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(v) for v in values.T]], names=["row", *FEATURES])

    return rows.select("row").mapInArrow(run, schema)


class ToxicityModel:
    """A fitted lexicon, trees and calibration."""

    def __init__(self, lexicons, trees, calibration, share):
        self.lexicons, self.trees, self.calibration, self.share = lexicons, trees, calibration, share

    def score(self, docs: DataFrame) -> DataFrame:
        """``row`` (a struct of all columns of ``docs``) and ``score``."""
        if self.trees is None:
            return packed(docs, F.lit(float(self.share)).alias("score"))
        return _calibrated(self.trees, self.calibration, _featured(packed(docs), self.lexicons)).select("row", "score")


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(rows)


def _raised(trees, rows: DataFrame) -> DataFrame:
    return trees.transform(_assembled(rows)).withColumn("_raised", vector_to_array("_probability")[1])


def _calibrated(trees, calibration, rows: DataFrame) -> DataFrame:
    """Isotonic steps with a hundredth of the raw probability, which orders rows on one step."""
    out = calibration.transform(_raised(trees, rows))
    return out.withColumn("score", F.least(F.lit(1.0), F.greatest(
        F.lit(0.0), 0.99 * F.col("_steps") + 0.01 * F.col("_raised"))))


def _both_kinds(rows: DataFrame, part) -> DataFrame:
    """The rows of a part, or all rows where the part lacks a kind of label."""
    chosen = rows.where(part)
    return chosen if chosen.select("y").distinct().count() == 2 else rows


def fit(docs: DataFrame, labels: DataFrame, learn=None, sample_rows: int = SAMPLE_ROWS, seed: int = 11) -> ToxicityModel:
    """Fit on at most ``sample_rows`` rows of ``labels`` (doc_id, toxic) that meet ``learn``.

    The sample's ids are bounded, so the join that fetches their texts broadcasts them.
    """
    on_executors(docs.sparkSession)
    known = labels.where("doc_id is not null and toxic is not null")
    if learn is not None:
        known = known.where(learn)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    sample = cut(texts.join(F.broadcast(chosen), "doc_id").withColumn(
        "fold", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(FOLDS)).cast("int")).repartition(24, "doc_id"), "toxic-sample")
    counts = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    calibrate = F.col("fold") == FOLDS - 1
    if len(counts) < 2:
        return ToxicityModel(None, None, None, share)
    lexicons = learn_lexicon(sample)
    rows = cut(_featured(packed(sample), lexicons, fold=True).select("row.doc_id", "row.y", "row.fold", *FEATURES)
               .coalesce(1).sortWithinPartitions("doc_id", *FEATURES), "toxic-features")
    trees = GBTClassifier(featuresCol="_features", labelCol="y", predictionCol="_predicted", maxIter=24, maxDepth=3, stepSize=0.2, seed=seed,
                          minInstancesPerNode=5)
    trees = trees.setRawPredictionCol("_raw").setProbabilityCol("_probability").fit(_assembled(_both_kinds(rows, ~calibrate)))
    last = _both_kinds(rows, calibrate)
    calibration = IsotonicRegression(featuresCol="_raised", labelCol="_y", predictionCol="_steps").fit(
        _raised(trees, last).select("_raised", F.col("y").cast("double").alias("_y")))
    return ToxicityModel(lexicons, trees, calibration, share)


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns stay."""
    return fit(docs, labels).score(docs).where(F.col("score") < threshold).select("row.*")
