"""Registered queries of the operators that mark stretches of texts, and of the alignment of two tokenizers."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegrid.llm import alignment, keyscan, periods
from tidegrid.llm.common import stored, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; in texts whose hashed id ends in 0 the words from some place on repeat with some period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.when(h % 10 == 0, F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"))
    rows = docs.select("doc_id", "text", g.alias("g"), words.alias("w")).withColumn("n", F.size("w").cast("bigint"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    tail = "slice(flatten(array_repeat(slice(w, int(a + 1), int(p)), int(ceil((n - a) / p)))), 1, int(n - a))"
    edited = F.expr(f"array_join(concat(slice(w, 1, int(a)), {tail}), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, edited).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, a tenth with a planted period: their runs, the longest run and the text without repetitions."""
    docs = with_planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periods.periodic_runs(docs, keep=["doc_id"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    best = F.expr("array_min(transform(runs, r -> struct(-r.length AS length, r.start AS start, r.period AS period)))")
    return found.select("doc_id", "collapsed", "runs", lines.alias("lines"), best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.length")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("-best.length * 1000 DIV best.period").alias("exponent_milli"),
        F.sha2(F.when(F.col("lines") == "", "").otherwise(F.concat("lines", F.lit("\n"))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES["op11_periodic_runs"] = op11_periodic_runs


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents aligned by a byte-level and a sentencepiece tokenizer, with corpus-wide counts of linked ids."""
    a, b = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), a, b, keep=["doc_id"], groups=False, digests=True)


QUERIES["op13_token_alignment"] = op13_token_alignment


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: base matches, and with them the strings that look random to models of this corpus."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = stored(keyscan.scan(docs, keep=["doc_id"]))
    found = keyscan.find(scanned, keyscan.train(keyscan.labelled(scanned, docs)))
    return found.select(F.col("row.doc_id"), *[f"n_{k}" for k in keyscan.KINDS], F.sha2("base_text", 256).alias("base_sha256"), "spans")


def _cut(source: str, text: str, pattern: str, group: int) -> str:
    """SQL of the gaps and matches of a pattern in ``text``: r (the row), gap, match, value and the place ``gap_at`` of the gap."""
    return f"""SELECT *, sum(length(gap) + coalesce(length(match), 0)) OVER (PARTITION BY r ORDER BY k) - length(gap) - coalesce(length(match), 0) AS gap_at
  FROM (SELECT r, unnest(range(len(gaps))) AS k, unnest(gaps) AS gap, unnest(found) AS match, unnest(vals) AS value
        FROM (SELECT r, string_split_regex({text}, '{pattern}') AS gaps, regexp_extract_all({text}, '{pattern}') AS found,
                     regexp_extract_all({text}, '{pattern}', {group}) AS vals FROM {source}))"""


_WORDS = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
_ASSIGN = _WORDS + r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_CODE = "greatest(1, least(95, ascii({}) - 31))"
QUERIES["op12_secrets"] = op12_secrets
ORACLE["op12_secrets"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text AS given, coalesce(text, '') AS text FROM documents),
a AS ({_cut("d", "text", _ASSIGN, 2)}),
k AS ({_cut("d", "text", keyscan.ACCESS, 0)}),
h AS ({_cut("d", "text", keyscan.HEX, 0)}),
base AS (
  SELECT r, 0 AS kind, gap_at + length(gap) AS start, gap_at + length(gap) + length(match) AS stop, value FROM a WHERE length(value) >= 12
  UNION ALL SELECT r, 1, gap_at + length(gap), gap_at + length(gap) + length(match), match FROM k WHERE match IS NOT NULL
  UNION ALL SELECT r, 2, gap_at + length(gap), gap_at + length(gap) + length(match), match FROM h WHERE match IS NOT NULL),
g AS (SELECT row_number() OVER () AS r, r AS doc, gap_at AS base_at, gap AS text FROM a),
c AS ({_cut("g", "text", keyscan.CANDIDATE, 0)}),
cand AS (
  SELECT g.doc AS r, 3 AS kind, base_at + gap_at + length(gap) AS start, base_at + gap_at + length(gap) + length(match) AS stop, match AS value
  FROM c JOIN g USING (r) WHERE match IS NOT NULL AND NOT regexp_matches(match, '{keyscan.HEX}|{keyscan.ACCESS}')),
words AS (
  SELECT unnest(regexp_extract_all(given, '{keyscan.WORD}')) AS s FROM d
  WHERE substr(md5(given), 1, 8) <= printf('%08x', least(4294967295, {keyscan.MAX_DOCS} * 4294967296 // (SELECT greatest(1, count(*)) FROM d)))),
samples AS (
  SELECT DISTINCT value AS s, 1 AS label FROM base
  UNION SELECT s, 0 FROM words WHERE length(s) < {keyscan.LEAST_CANDIDATE} OR regexp_full_match(s, '[A-Za-z]+') AND NOT regexp_matches(s, '{keyscan.HEX}|{keyscan.ACCESS}')),
marked AS (SELECT s, label, substr(md5(s), 1, 1) IN ('0', '1', '2') AS held FROM samples WHERE s != ''),
n AS (
  SELECT label, x, y, count(*) AS n
  FROM (SELECT label, CASE WHEN i = 1 THEN 0 ELSE {_CODE.format("substr(s, i - 1, 1)")} END AS x, {_CODE.format("substr(s, i, 1)")} AS y
        FROM (SELECT label, s, unnest(range(1, length(s) + 1)) AS i FROM marked WHERE NOT held)) GROUP BY ALL),
cells AS (
  SELECT x, y, label
  FROM (SELECT unnest(range(96)) AS x), (SELECT unnest(range(1, 96)) AS y), (SELECT unnest([0, 1]) AS label)),
chances AS (
  SELECT x, y, label, (coalesce(n, 0) + {keyscan.PRIOR})::DOUBLE / ({keyscan.PRIOR * 95} + sum(coalesce(n, 0)) OVER (PARTITION BY label, x)) AS p
  FROM cells LEFT JOIN n USING (x, y, label)),
ratio AS (SELECT o.x, o.y, round(1000 * ln(q.p / o.p))::BIGINT AS v FROM chances o JOIN chances q USING (x, y) WHERE o.label = 0 AND q.label = 1),
tried AS (SELECT DISTINCT value AS s FROM cand UNION SELECT s FROM marked WHERE held AND length(s) >= {keyscan.LEAST_CANDIDATE}),
scores AS (
  SELECT s, sum(v) AS score
  FROM (SELECT s, CASE WHEN i = 1 THEN 0 ELSE {_CODE.format("substr(s, i - 1, 1)")} END AS x, {_CODE.format("substr(s, i, 1)")} AS y
        FROM (SELECT s, unnest(range(1, length(s) + 1)) AS i FROM tried)) JOIN ratio USING (x, y) GROUP BY s),
least_score AS (
  SELECT coalesce(greatest(coalesce(rnd, 0), round(ord) + 1), rnd, 0) AS t
  FROM (SELECT quantile_cont(score, {1 - keyscan.FALSE_SHARE}) FILTER (WHERE label = 0) AS ord,
               round(quantile_cont(score, {keyscan.MISSED_SHARE}) FILTER (WHERE label = 1)) AS rnd
        FROM marked JOIN scores USING (s) WHERE held AND length(s) >= {keyscan.LEAST_CANDIDATE})),
spans AS (
  SELECT r, kind, start, stop FROM base
  UNION ALL SELECT r, kind, start, stop FROM cand JOIN scores ON s = value, least_score WHERE score >= t),
listed AS (
  SELECT r, string_agg(['assign', 'access', 'hex', 'random'][kind + 1] || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, kind) AS spans,
         string_agg(['assign', 'access', 'hex', 'random'][kind + 1] || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, kind) FILTER (WHERE kind < 3) AS own,
         count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex
  FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (r)"""
