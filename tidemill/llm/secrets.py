"""Secret scans with multipart credential linking (operator 10), in DataFrame functions only.

Strong parts are reported wherever they stand: ``assign`` (a keyword, ``:`` or ``=``, and a
value of six characters or more), ``access`` (access identifiers) and ``hex`` (long runs of
hexadecimal digits).  Weak parts mean little alone: ``login`` (account names), ``bare`` (runs
of exactly 40 base-64 characters) and ``endpoint`` (addresses).  Every part has a role -
identifier, secret or endpoint - and parts of one document are joined on the interval between
their beginnings: a weak part is reported only if a part of another role begins within
``SCOPE`` code points of it, and that part is strong or one of the two is a secret.  A weak
part inside a strong one is not reported twice.

Everything happens within the row, so there is no shuffle: matches and the text between them
give the positions, and the parts are sorted by position.  The parts of one kind never overlap, so
of each kind one part decides: the last that begins before a weak part's end covers it or none
does, and the last that begins up to ``SCOPE`` behind its beginning is near it or none is.  Which
one that is comes from sorting the beginnings of a kind and the places in question together; sums
run over chunks of ``CHUNK`` entries and then over the chunks' totals.

Edge cases: null text counts as empty and has no parts; several rows of one ``doc_id`` are
scanned each for itself; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed

SCOPE, CHUNK = 200, 128

# The patterns, in the order in which kinds are listed.
PATTERNS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "login": r"""(?i)(user|username|user_name|login|client_?id|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]+)""",
    "bare": r"[A-Za-z0-9+/]{40,}",
    "endpoint": r"""[a-z][a-z0-9+]{1,9}://[^\x20\x09-\x0D"'<>]+""",
}
KINDS = list(PATTERNS)
STRONG = KINDS[:3]
ROLES = {"assign": "secret", "access": "identifier", "hex": "secret",
         "login": "identifier", "bare": "secret", "endpoint": "endpoint"}
# What a text must hold for a pattern to be tried, and the least sizes.
NEEDS = {"assign": [":", "="], "access": ["AKIA"], "hex": [], "login": [":", "="], "bare": [":", "=", "AKIA"],
         "endpoint": ["://"]}
LEAST_VALUE = {"assign": 6, "login": 3}
BARE_SIZE = 40

_PART = "array<struct<start:int,kind:int,end:int>>"


def _let(value, use):
    """``use(value)`` with the value worked out once, also where it stands inside a function of entries."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _chunks(entries):
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(entries) - 1) / CHUNK).cast("int")),
                       lambda c: F.slice(entries, c * CHUNK + 1, F.lit(CHUNK)))


def _running(values, combine):
    """For each entry of an array of whole numbers what ``combine`` makes of those before it (0 for the
    first); an array copied entry by entry would cost the square of its size, so chunks are."""
    grown = lambda acc, x: F.concat(acc, F.array(combine(F.element_at(acc, -1), x)))
    inside = lambda chunks: F.transform(chunks, lambda chunk: F.aggregate(chunk, F.array(F.lit(0)), grown))

    def put_together(runs):
        before = F.aggregate(runs, F.array(F.lit(0)), lambda acc, x: grown(acc, F.element_at(x, -1)))
        return F.flatten(F.transform(F.arrays_zip(runs.alias("run"), F.slice(before, 1, F.size(runs)).alias("at")), lambda x: F.transform(
            F.slice(x["run"], 1, F.size(x["run"]) - 1), lambda v: combine(x["at"], v))))

    return _let(values, lambda own: F.when(F.size(own) > 0, _let(inside(_chunks(own)), put_together)).otherwise(F.array().cast("array<int>")))


def _below(starts, at):
    """For each entry of ``at`` how many ``starts`` are less."""
    marks = F.concat(F.transform(starts, lambda v: F.struct(v.alias("v"), F.lit(1).alias("is_start"), F.lit(-1).alias("i"))),
                     F.transform(at, lambda v, i: F.struct(v.alias("v"), F.lit(0).alias("is_start"), i.alias("i"))))
    placed = F.transform(F.array_sort(marks), lambda x, place: F.struct(x["i"].alias("i"), place.alias("place"), x["is_start"].alias("is_start")))
    asked = F.filter(placed, lambda x: x["is_start"] == 0)
    counts = F.transform(asked, lambda x, k: F.struct(x["i"].alias("i"), (x["place"] - k).alias("n")))
    return F.transform(F.array_sort(counts), lambda x: x["n"])


def _tried(text, kind: str, group: int):
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(group))
    gate = None
    for needed in NEEDS[kind]:
        gate = text.contains(needed) if gate is None else gate | text.contains(needed)
    return found if gate is None else F.when(gate, found).otherwise(F.array().cast("array<string>"))


def _located(text, matches, values, kind: str):
    """Parts of one kind: the text between matches and the matches themselves give positions."""
    number = KINDS.index(kind)
    between = F.slice(F.split(text, PATTERNS[kind], -1), 1, F.size(matches))
    zipped = F.transform(F.arrays_zip(between.alias("g"), matches.alias("m"), (matches if values is None else values).alias("v")),
                         lambda x: F.struct(F.char_length(x["g"]).alias("g"), F.char_length(x["m"]).alias("m"), F.char_length(x["v"]).alias("v")))

    def part(x):
        start = x["at"] + x["x"]["g"]
        return F.struct(start.alias("start"), F.lit(number).alias("kind"), (start + x["x"]["m"]).alias("end"))

    good = lambda x: F.lit(True)
    if kind in LEAST_VALUE:
        good = lambda x: x["x"]["v"] >= LEAST_VALUE[kind]
    elif kind == "bare":
        good = lambda x: x["x"]["m"] == BARE_SIZE
    def placed(entries):
        before = _running(F.transform(entries, lambda x: x["g"] + x["m"]), lambda a, b: a + b)
        return F.transform(F.filter(F.arrays_zip(before.alias("at"), entries.alias("x")), good), part)

    return F.when(F.size(matches) > 0, _let(zipped, placed)).otherwise(F.array().cast(_PART))


def _complements(kind: str, weak: str) -> bool:
    """Whether a part of ``kind`` beside a weak part makes that one worth reporting."""
    return ROLES[kind] != ROLES[weak] and (kind in STRONG or "secret" in (ROLES[kind], ROLES[weak]))


def _with_linked(found: DataFrame) -> DataFrame:
    """``found`` (an array ``p_<kind>`` of each kind's parts) with ``parts``: the strong ones, and the weak ones
    whose scope holds a complementary part and that no strong one covers."""
    weak = F.concat(*[F.col(f"p_{k}") for k in KINDS[len(STRONG):]])
    out = found.withColumn("weak", weak)
    starts = lambda k: F.transform(f"p_{k}", lambda p: p["start"])
    for k in KINDS:
        out = out.withColumn(f"near_{k}", _below(starts(k), F.transform("weak", lambda w: w["start"] + SCOPE + 1)))
        if k in STRONG:
            out = out.withColumn(f"over_{k}", _below(starts(k), F.transform("weak", lambda w: w["end"])))

    def last(k, n, i, holds):
        """Whether the last of the first so many parts of a kind is what is asked for."""
        count = F.get(f"{n}_{k}", i)
        return F.coalesce((count > 0) & holds(F.get(f"p_{k}", count - 1)), F.lit(False))

    def any_of(conditions):
        whole = F.lit(False)
        for c in conditions:
            whole = whole | c
        return whole

    def stays(w, i):
        beside = any_of((w["kind"] == KINDS.index(own)) & any_of(
            last(k, "near", i, lambda p: p["start"] >= w["start"] - SCOPE) for k in KINDS if _complements(k, own)) for own in KINDS[len(STRONG):])
        return beside & ~any_of(last(k, "over", i, lambda p: p["end"] > w["start"]) for k in STRONG)

    linked = F.array_sort(F.concat("base", F.filter("weak", stays)))
    return out.withColumn("parts", F.when(F.size("weak") > 0, linked).otherwise(F.col("base")))


def scan(docs: DataFrame) -> DataFrame:
    """``row`` (a struct of all columns), ``text``, and ``base`` and ``parts``: arrays of (start, kind,
    end) sorted by start, then kind as listed; positions are code points, the end exclusive."""
    out = packed(docs, F.coalesce(F.col("text"), F.lit("")).alias("text"))
    text = F.col("text")
    for kind in KINDS:
        out = out.withColumn(f"m_{kind}", _tried(text, kind, 0))
        if kind in LEAST_VALUE:
            out = out.withColumn(f"v_{kind}", _tried(text, kind, 2))
    for kind in KINDS:
        value = F.col(f"v_{kind}") if kind in LEAST_VALUE else None
        out = out.withColumn(f"p_{kind}", _located(text, F.col(f"m_{kind}"), value, kind))
    out = out.withColumn("base", F.array_sort(F.concat(*[F.col(f"p_{k}") for k in STRONG])))
    return _with_linked(out).select("row", "text", "base", "parts")


def listed(parts) -> F.Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(parts, lambda p: F.concat_ws(
        ":", F.get(names, p["kind"]), p["start"].cast("string"), p["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts of the strong kinds, a digest of them, all spans."""
    found = scan(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda p: p["kind"] == KINDS.index(k))).cast("long")
    return found.select(F.col("row.doc_id").alias("doc_id"), *[count(k).alias(f"n_{k}") for k in STRONG],
                        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        listed(F.col("parts")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every reported span replaced by its kind in brackets; all rows and columns stay.

    Overlapping spans become one mark, named after the first.  ``n_chars``, where present,
    follows the new text.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text, parts = F.col("text"), F.col("parts")

    def spelled(chunk):
        """The marks of a chunk of parts with the text between; places are counted from the chunk's own text."""
        first = F.get(chunk, F.lit(0))["at"]
        own = F.substring(text, first + 1, F.element_at(chunk, -1)["p"]["start"] - first)
        return F.array_join(_let(own, lambda o: F.transform(chunk, lambda x: F.when(
            x["p"]["start"] >= x["at"], F.concat(F.substring(o, x["at"] - first + 1, x["p"]["start"] - x["at"]),
                                                F.get(names, x["p"]["kind"]))).otherwise(F.lit("")))), "")

    def whole(upto):  # where the parts before each end
        last = F.greatest(F.element_at(upto, -1), F.element_at(parts, -1)["end"])
        chunks = _let(F.arrays_zip(upto.alias("at"), parts.alias("p")), _chunks)
        return F.concat(F.array_join(F.transform(chunks, spelled), ""), F.substring(text, last + 1, F.char_length(text)))

    marked = _let(_running(F.transform(parts, lambda p: p["end"]), F.greatest), whole)
    hit = F.size("parts") > 0
    out = scan(docs).select("row", hit.alias("hit"), F.when(hit, marked).alias("clean"))
    new = {"text": F.when(F.col("hit"), F.col("clean")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("hit"), F.char_length("clean").cast(kind)).otherwise(F.col("row.n_chars"))
    return out.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
