from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..conversations import ordered_turns, prefix_trie
from ..shared import dealt_join, staged, table


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of conversations that begin like another one.

    Conversation c takes the first h turns of conversation c - c % 5, then its own after its first h; h is the
    unsigned CRC-32 of c's digits, modulo 9. A conversation that is missing gives no turns.
    """
    h = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % 9
    own = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    base = own.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    lengths = own.select("conv", "n", h("conv").alias("h"), (F.col("conv") - F.col("conv") % 5).alias("_base")).join(base, F.col("_base") == F.col("base"), "left")
    lengths = lengths.withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    lengths = staged(lengths.select("conv", "n", "h", "_base", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")), "lengths")
    heads = turns.where((F.col("conv") % 5 == 0) & (F.col("pos") < 8)).withColumnRenamed("conv", "base")
    begin = lengths.where("taken > 0").select("conv", "_base", "taken").join(heads, (F.col("_base") == F.col("base")) & (F.col("pos") < F.col("taken")))
    moved = lengths.where("taken < h").select("conv", F.col("n").alias("held"), (F.col("h") - F.col("taken")).alias("shift"))
    rest = dealt_join(turns.where(F.col("pos") >= h("conv")), moved, ["conv"], "held").withColumn("pos", F.col("pos") - F.coalesce("shift", F.lit(0)))
    names = ["conv", "pos", "k1", "k2", "size"]
    return staged(begin.select(*names).unionByName(rest.select(*names)), "rebuilt"), lengths.select("conv", "total")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of the rebuilt conversations."""
    return prefix_trie(*rebuilt(ordered_turns(table(spark, sf_dir, "conversations"))))


#: CRC-32 of the digits of a number, bit by bit.
_CRC = """xor(4294967295, list_reduce(
  list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: xor(c >> 1, (c & 1) * 3988292384))))"""

SQL = f"""
WITH turns AS (
  SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv, {_CRC} % 9 AS h FROM (SELECT DISTINCT conv FROM turns)),
parts AS (
  SELECT i.conv, 0 AS part, t.pos, t.role, t.text FROM ids i JOIN turns t ON t.conv = i.conv - i.conv % 5 AND t.pos < i.h
  UNION ALL
  SELECT i.conv, 1 AS part, t.pos, t.role, t.text FROM ids i JOIN turns t ON t.conv = i.conv AND t.pos >= i.h),
numbered AS (SELECT conv, role, text, row_number() OVER (PARTITION BY conv ORDER BY part, pos) AS depth FROM parts),
hashed AS (SELECT conv, depth, octet_length(encode(text)) AS size, sha256(concat(strlen(role), ':', role, text)) AS turn FROM numbered),
paths AS (
  SELECT conv, depth, size, string_agg(turn, '/') OVER (PARTITION BY conv ORDER BY depth) AS path FROM hashed
  UNION ALL SELECT conv, 0, 0, '' FROM ids),
ended AS (SELECT conv, max(depth) AS depth FROM paths GROUP BY conv),
nodes AS (
  SELECT p.path, p.depth, max(p.size) AS size, min(p.conv) AS conv, count(*) AS n,
    sha256(coalesce(string_agg(CASE WHEN p.depth = e.depth THEN CAST(p.conv AS VARCHAR) END, ',' ORDER BY p.conv), '')) AS ends
  FROM paths p JOIN ended e ON e.conv = p.conv GROUP BY p.path, p.depth),
edges AS (
  SELECT a.path, a.depth, p.path AS up, p.conv AS up_conv
  FROM nodes a JOIN nodes p ON p.depth = a.depth - 1 AND p.path = CASE WHEN a.depth = 1 THEN '' ELSE left(a.path, 65 * (CAST(a.depth AS INTEGER) - 1) - 1) END),
kids AS (SELECT up, count(*) AS children FROM edges GROUP BY up),
whole AS (
  SELECT n.*, coalesce(k.children, 0) AS children, (n.n - 1) * n.size AS saved FROM nodes n LEFT JOIN kids k ON k.up = n.path),
spread AS (SELECT w.*, unnest(range(0, CAST(w.depth AS BIGINT) + 1)) AS above FROM whole w),
sums AS (
  SELECT above, CASE WHEN above = 0 THEN '' ELSE left(path, 65 * CAST(above AS INTEGER) - 1) END AS path,
    sum(CASE WHEN children = 0 THEN 1 ELSE 0 END) AS leaves, sum(saved) AS saved
  FROM spread GROUP BY ALL)
SELECT w.conv AS conv_id, CAST(w.depth AS BIGINT) AS depth, e.up_conv AS parent_conv_id, w.n AS n_convs, CAST(w.children AS BIGINT) AS n_children,
  CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, w.ends AS ends_sha256
FROM whole w JOIN sums s ON s.path = w.path AND s.above = w.depth LEFT JOIN edges e ON e.path = w.path AND e.depth = w.depth
"""
