from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import table
from ..vectorcodes import vector_codes


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and errors of every usable vector, and a digest of the codebooks."""
    coded, books = vector_codes(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _round(number: int, before: str) -> str:
    """The nearest entry of every part, then the entries' new components."""
    return f"""
far{number} AS (
  SELECT e.vec_id, e.part, c.entry, sum((e.v - c.v) * (e.v - c.v)) AS far
  FROM elems e JOIN {before} c ON e.part = c.part AND e.place = c.place GROUP BY ALL),
at{number} AS (
  SELECT vec_id, part, entry, far FROM far{number}
  QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY far, entry) = 1),
moved{number} AS (
  SELECT a.part, a.entry, e.place, CAST(sum(e.v) AS BIGINT) AS s, count(*) AS n
  FROM at{number} a JOIN elems e ON e.vec_id = a.vec_id AND e.part = a.part GROUP BY ALL),
book{number} AS (
  SELECT c.part, c.entry, c.place,
    CASE WHEN m.n IS NULL THEN c.v ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS v
  FROM {before} c LEFT JOIN moved{number} m ON m.part = c.part AND m.entry = c.entry AND m.place = c.place)"""


SQL = f"""
WITH kept AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (
  SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS place, len(embedding) AS dim FROM kept),
elems AS (
  SELECT vec_id, place // (dim // 4) AS part, place, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS v FROM flat),
start AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 256),
book0 AS (SELECT e.part, s.entry, e.place, e.v FROM start s JOIN elems e ON e.vec_id = s.vec_id),
{", ".join(_round(k, f"book{k - 1}") for k in range(1, 6))},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
  FROM at5 GROUP BY vec_id)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY part, entry, place)) FROM book4) AS codebooks_sha256
FROM kept k JOIN coded c ON c.vec_id = k.vec_id
"""
