from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..licenses import PHRASES, TEMPLATES, license_scan, template_rows
from ..shared import table


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_phrases = ", ".join(f"({_list(p.split(' '))}, '{label}')" for p, label in PHRASES.items())
_notices = ", ".join(f"({k}, '{label}', {_list(words)}, {needed})" for k, label, words, needed in template_rows(TEMPLATES, 0.9))

SQL = rf"""
WITH phrases(words, label) AS (VALUES {_phrases}),
notices(k, label, words, needed) AS (VALUES {_notices}),
d AS (
  SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), w AS (
  SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM d
), starts AS (
  SELECT rid, words, unnest(range(1, len(words) + 1)) AS p FROM w
), base AS (
  SELECT rid, count(*) AS n_base, min(p) - 1 AS first_word, max(p) - 1 AS last_word, list_sort(list(DISTINCT label)) AS labels
  FROM starts JOIN phrases ON starts.words[p : p + len(phrases.words) - 1] = phrases.words GROUP BY rid
), lines AS (
  SELECT rid, list_distinct(regexp_extract_all(line, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS words
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
), method AS (
  SELECT rid, list(DISTINCT label) AS labels, max(len(list_intersect(lines.words, notices.words))::DOUBLE / len(notices.words)) AS score
  FROM lines, notices WHERE len(list_intersect(lines.words, notices.words)) >= needed GROUP BY rid
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(base.labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(method.labels, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(method.score, 0.0::DOUBLE) END AS score
FROM w LEFT JOIN base USING (rid) LEFT JOIN method USING (rid)
"""
