from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..hostrules import METRICS, host_rules
from ..shared import table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return host_rules_without_text(docs)


def host_rules_without_text(docs: DataFrame) -> DataFrame:
    return host_rules(docs, with_text=False).select("doc_id", *METRICS, "kept")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT rid, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM d
), win AS (
  SELECT rid, unnest(range(1, len(words) - 1)) AS p, words FROM w WHERE len(words) >= 3
), win2 AS (
  SELECT rid, p, count(*) OVER (PARTITION BY rid, words[p], words[p + 1], words[p + 2]) AS c FROM win
), cov AS (
  SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM win2 WHERE c >= 2) GROUP BY rid
), m AS (
  SELECT doc_id, source, len(words) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
         coalesce(cov.n, 0) AS n_repeat_words
  FROM w LEFT JOIN cov USING (rid)
), f AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
         [n_words < 50, 100 * n_repeat_words > 50 * n_words, 10 * n_symbols > word_chars, 2 * n_dup_lines > n_lines] AS failed
  FROM m
), h AS (
  SELECT source, k, count(*)::DOUBLE AS n, count(*) FILTER (WHERE failed[k])::DOUBLE AS bad
  FROM f, (VALUES (1), (2), (3), (4)) t(k) GROUP BY source, k
), p AS (
  SELECT k, sum(bad) / sum(n) AS mean, sum(bad) AS bad, sum(n) AS docs, count(*) AS h,
         sum(n * n) AS n2, sum(bad * bad / n) AS f2
  FROM h GROUP BY k
), s AS (
  SELECT k, mean, mean * (1 - mean) AS chance,
         CASE WHEN docs - n2 / docs <> 0 THEN (f2 - bad * mean - (h - 1) * mean * (1 - mean)) / (docs - n2 / docs) END AS spread
  FROM p
), v AS (
  SELECT source, bool_or((bad + mean * strength) / (n + strength) > 0.5) AS rejected
  FROM h JOIN (SELECT k, mean, CASE WHEN spread > 0 AND chance > 0 THEN greatest(1.0, least(1e6, chance / spread - 1)) ELSE 1e6 END AS strength FROM s) USING (k)
  GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND NOT rejected) AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""
