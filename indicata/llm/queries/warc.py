from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..shared import table
from ..warc import archived


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, encode(coalesce(html, '')) AS bytes FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS first FROM p
)
SELECT page_id, octet_length(bytes)::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN octet_length(bytes) >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN octet_length(bytes) >= 1000 AND page_id <> first THEN first END AS refers_to
FROM g
"""
