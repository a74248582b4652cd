"""Registered queries of the document operators, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from keyfold.llm import (
    byte_bpe,
    fingerprints,
    language,
    lexical,
    license_scan,
    ngram_join,
    packing,
    pii,
    quality,
    sharding,
    spelling,
    token_counts,
    token_files,
)
from keyfold.llm.store import new_folder

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


# A caller keeps its own key secret; this one is for the synthetic tables.
PII_KEY = "synthetic-tables"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.lengths(
        documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN
    )
    return token_counts.suffix_sums(token_counts.histogram(counts))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = ngram_join.Likeness(n=3, part=90, over=100)
    return ngram_join.document_components(documents(spark, sf_dir), rule)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op4_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir), key=PII_KEY)


def op5_multiset_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(documents(spark, sf_dir))


def op6_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(documents(spark, sf_dir))


def op7_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(documents(spark, sf_dir))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)


def op9_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), WORDS, end_id=2, capacity=4096)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    token_files.write_tokens(documents(spark, sf_dir), folder, WORDS, end_id=1)
    return token_files.read_digests(spark, folder)


def op11_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(documents(spark, sf_dir), shards=24)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(documents(spark, sf_dir))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical.rank(documents(spark, sf_dir), items, k=10)


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_ngram_join,
        op3_license_scan,
        op4_pii_feistel,
        op5_multiset_fingerprints,
        op6_language_crf,
        op7_host_quality,
        op8_byte_bpe,
        op9_harmonic_packing,
        op10_token_files,
        op11_rendezvous_shards,
        op12_spelling_variants,
        op13_ranked_search,
    )
}

_WORD = r"[^\x20\x09-\x0D]+"

_OP2 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') ws FROM documents),
places AS (
  SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) p FROM w WHERE len(ws) > 0),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, p, p + 2), ' ') g FROM places),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY 1),
k AS (
  SELECT a.doc_id a, b.doc_id b, count(*) k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM k JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 90 * (x.n + y.n - k)),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM w
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.r) AS component_id
FROM w JOIN reach ON reach.doc_id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id GROUP BY w.doc_id
"""

_OP7 = rf"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '{_WORD}') ws
  FROM documents),
places AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) p FROM w WHERE len(ws) >= 8),
g AS (SELECT doc_id, p, array_to_string(list_slice(ws, p, p + 7), ' ') g FROM places),
again AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) c FROM g)
  WHERE c > 1),
covered AS (
  SELECT doc_id, count(DISTINCT q) n
  FROM (SELECT doc_id, unnest(range(p, p + 8)) q FROM again) GROUP BY 1),
line AS (
  SELECT doc_id, l FROM (SELECT doc_id, unnest(string_split(t, chr(10))) l FROM w)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
lines AS (SELECT doc_id, count(*) n, count(*) - count(DISTINCT l) dup FROM line GROUP BY 1),
m AS (
  SELECT w.doc_id, source, len(ws) n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) n_symbols,
    coalesce(lines.dup, 0) n_dup_lines, coalesce(covered.n, 0) n_repeat_words,
    coalesce(lines.n, 0) n_lines
  FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    n_symbols > 0.1 * n_words OR n_dup_lines > 0.3 * n_lines AS rule_failed FROM m),
h AS (
  SELECT source, count(*) n, sum((base_failed OR rule_failed)::INT) x FROM f GROUP BY 1),
mo AS (
  SELECT avg(x / n) mean, var_pop(x / n) - avg(x / n) * (1 - avg(x / n)) * avg(1 / n) b,
    sum(x) / sum(n) total FROM h),
prior AS (
  SELECT CASE WHEN b > 0 AND mean > 0 AND mean < 1 THEN mean ELSE total END mu,
    CASE WHEN b > 0 AND mean > 0 AND mean < 1
      THEN greatest(mean * (1 - mean) / b - 1, 1e-6) ELSE 1e9 END wt FROM mo),
v AS (SELECT source, (x + mu * wt) / (n + wt) > 0.5 bad FROM h, prior)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT rule_failed AND NOT bad AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_OP13 = rf"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{_TERM}') ts FROM documents),
d AS (SELECT row_number() OVER () r, doc_id, ts, len(ts)::BIGINT n FROM low WHERE len(ts) > 0),
corpus AS (SELECT count(*)::BIGINT nd, sum(n)::BIGINT l FROM d),
wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) t FROM benchmark WHERE item_id IS NOT NULL),
tf AS (
  SELECT r, t, count(*)::BIGINT tf FROM (SELECT r, unnest(ts) t FROM d)
  WHERE t IN (SELECT t FROM wanted) GROUP BY 1, 2),
w AS (
  SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)))::BIGINT w
  FROM (SELECT t, count(*)::BIGINT df FROM tf GROUP BY 1), corpus),
s AS (
  SELECT item_id, r, sum(w.w * ((1000000000 * tf.tf) //
    (1000 * tf.tf + 8 * (10 + (90 * d.n * nd) // l))))::BIGINT score
  FROM wanted JOIN tf USING (t) JOIN w USING (t) JOIN d USING (r), corpus GROUP BY 1, 2),
k AS (
  SELECT item_id, doc_id, score,
    row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) k
  FROM s JOIN d USING (r) WHERE score > 0)
SELECT item_id, k::INT AS rank, doc_id, score FROM k WHERE k <= 10
"""

ORACLES = {"op2_ngram_join": _OP2, "op7_host_quality": _OP7, "op13_ranked_search": _OP13}
