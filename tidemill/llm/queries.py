"""Registered queries of the training-data operators, and DuckDB SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import (alignment, bpe, fingerprints, hnsw, minhash, mixing, passages, pieces, secrets, sharding, token_counts, toxicity,
               whitening)
from .common import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document when sources of weights 5, 2, 1, repeating, share 150 %."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(docs, mixing.ranked_weights(docs, [5, 2, 1]), budget_ratio=1.5, max_epochs=2.0)
    return mixed.select("row.doc_id", "row.source", "size", "source_size", "target",
                        (F.col("size") * F.col("times")).alias("taken"))


def op2_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose id is divisible by 20, among all other rows."""
    rows = hnsw.vectors(table(spark, sf_dir, "embeddings"))
    return hnsw.search_index(hnsw.build_index(rows), rows.where("id % 20 = 0"), k=20)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), ~toxicity.held_out("doc_id"))
    return model.score(docs).select("row.doc_id", toxicity.held_out("row.doc_id").alias("held_out"), "score",
                                    (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that a document shares with an earlier one, as start:end in words."""
    found = passages.repeated_passages(table(spark, sf_dir, "documents"))
    span = lambda a, b: F.concat_ws(":", F.col(a).cast("string"), F.col(b).cast("string"))
    return found.select("doc_id", "other_id", span("start", "end").alias("passage"),
                        span("other_start", "other_end").alias("other_passage"), "identity")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every text, and whether its pieces spell the text again."""
    return pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents with 85 % of their five-word shingles in common."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every text, before and after two edits that are counted incrementally."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs).withColumn("edits", token_counts.sample_edits(F.col("text")))
    before = counted.withColumnsRenamed({"n_tokens": "tokens_before"}).withColumn("n_tokens", F.col("tokens_before"))
    edited = token_counts.apply_edits(before)
    return edited.select("doc_id", F.col("tokens_before").alias("n_tokens"), F.get("leaf_chars", F.lit(0)).alias("n_leaves"),
                         F.char_length("text").cast("long").alias("edited_chars"), F.col("n_tokens").alias("edited_tokens"),
                         "encoded_chars", F.crc32(F.col("text").cast("binary")).alias("edited_crc32"))


def op8_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 shards of near equal bytes, split along language, source and size."""
    shards = sharding.kd_shards(table(spark, sf_dir, "documents"), 40)
    return shards.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k fingerprints of every text and its edited text, and how alike they are."""
    return fingerprints.report(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text: the base kinds, and weak parts beside complementary ones."""
    return secrets.report(table(spark, sf_dir, "documents"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text by merges, and digests of the ids and of what they decode to."""
    return bpe.report(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first eight components of all, each with unit variance."""
    return whitening.report(table(spark, sf_dir, "embeddings"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two vocabularies that end together in every text, and how common these links are."""
    return alignment.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_hnsw": op2_hnsw,
    "op3_toxicity": op3_toxicity,
    "op4_repeated_passages": op4_repeated_passages,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_kd_sharding": op8_kd_sharding,
    "op9_fingerprints": op9_fingerprints,
    "op10_secret_scan": op10_secret_scan,
    "op11_bpe": op11_bpe,
    "op12_whitening": op12_whitening,
    "op13_token_alignment": op13_token_alignment,
}

# Water-filling in closed form: clamped sources are the first by cap and weight, and the level is that
# of the first source left; then rows in hash order up to the nearer side of what remains.
OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('17|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS code
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS ss, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
      FROM d GROUP BY source),
t AS (SELECT *, 2.0 * ss AS cap, row_number() OVER o AS k, sum(2.0 * ss) OVER o - 2.0 * ss AS held, sum(w) OVER () - sum(w) OVER o + w AS free,
             (SELECT 1.5 * sum(ss) FROM s) AS budget FROM s WINDOW o AS (ORDER BY 2.0 * ss / w, source ROWS UNBOUNDED PRECEDING)),
level AS (SELECT arg_min((budget - held) / free, k) AS l FROM t WHERE (budget - held) / free * w <= cap),
p AS (SELECT source, ss, least(cap, l * w)::DOUBLE AS target FROM t, level),
q AS (SELECT *, floor(target / ss + 1e-12) AS whole, target - floor(target / ss + 1e-12) * ss AS rest FROM p),
c AS (SELECT d.*, q.ss, q.target, q.whole, q.rest, sum(d.size) OVER (PARTITION BY d.source ORDER BY d.code) AS cum,
             sum(d.size) OVER (PARTITION BY d.source, d.code) AS unit
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, source, size, ss AS source_size, target,
       (size * (whole + CASE WHEN cum - unit < rest AND (cum < rest OR rest - (cum - unit) >= unit / 2.0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""

# Exact classes on the full shingle sets: links by counting shared shingles, reach by recursion.
OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN list_aggregate(ws, 'string_agg', ' ')
           ELSE list_aggregate(ws[i:i + 4], 'string_agg', ' ') END AS g
  FROM w, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS r(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
          GROUP BY 1, 2),
links AS (SELECT a, b FROM both_ JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * c >= 85 * (na.n + nb.n - c)),
ends_ AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, ends_.b FROM reach JOIN ends_ ON ends_.a = reach.y)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.y) AS component_id, d.doc_id = min(r.y) AS kept
FROM documents d JOIN reach r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""



def _op10_sql() -> str:
    """Matches and the text between them give positions; weak parts are joined to parts near them."""
    quoted = {k: p.replace("'", "''") for k, p in secrets.PATTERNS.items()}
    found = " UNION ALL ".join(
        f"""SELECT doc_id, {i} AS kind, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(vs) AS v, unnest(gs[1:len(ms)]) AS g
        FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS ms, regexp_extract_all(t, '{p}', {2 if k in secrets.LEAST_VALUE else 0}) AS vs,
                     regexp_split_to_array(t, '{p}') AS gs FROM d)""" for i, (k, p) in enumerate(quoted.items()))
    keep = " WHEN ".join(f"{i} THEN {'length(v) >= %d' % secrets.LEAST_VALUE[k] if k in secrets.LEAST_VALUE else 'length(m) = 40' if k == 'bare' else 'true'}"
                         for i, k in enumerate(secrets.KINDS))
    role = " WHEN ".join(f"{i} THEN '{secrets.ROLES[k]}'" for i, k in enumerate(secrets.KINDS))
    name = " WHEN ".join(f"{i} THEN '{k}'" for i, k in enumerate(secrets.KINDS))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({found}),
placed AS (SELECT *, (sum(length(g)) OVER w + coalesce(sum(length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS s FROM found WINDOW w AS (PARTITION BY doc_id, kind ORDER BY i)),
part AS (SELECT doc_id, kind, s, s + length(m) AS e, CASE kind WHEN {role} END AS role, kind < {len(secrets.STRONG)} AS strong,
                CASE kind WHEN {name} END || ':' || s || ':' || (s + length(m)) AS shown
         FROM placed WHERE CASE kind WHEN {keep} END),
kept AS (SELECT * FROM part w WHERE strong OR (
           EXISTS (SELECT 1 FROM part p WHERE p.doc_id = w.doc_id AND p.role <> w.role AND abs(p.s - w.s) <= {secrets.SCOPE}
                   AND (p.strong OR p.role = 'secret' OR w.role = 'secret'))
           AND NOT EXISTS (SELECT 1 FROM part p WHERE p.doc_id = w.doc_id AND p.strong AND p.s < w.e AND w.s < p.e))),
shown AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
                 count(*) FILTER (kind = 2) AS n_hex,
                 string_agg(shown, ',' ORDER BY s, kind, e) FILTER (strong) AS base, string_agg(shown, ',' ORDER BY s, kind, e) AS spans
          FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN shown USING (doc_id)
"""


ORACLE: dict[str, str] = {
    "op1_mixing": OP1_SQL,
    "op6_minhash_near_dedup": OP6_SQL,
    "op10_secret_scan": _op10_sql(),
}
