"""Connected components of a graph of links, by alternating large and small stars.

Each round is a few shuffles of the links; nothing but two totals reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import dealt_join, drop_staged, staged


#: Links that one task writes, about: few links are not spread over many small files, round after round.
LINKS = 1 << 18


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node, root`` for every node with a link to another one; ``root`` is the smallest id of its component.

    Self links, repeated links and links with a null end are ignored. Ids are longs.
    """
    whole = F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col(left) != F.col(right))
    pairs = links.where(whole).select(F.greatest(left, right).alias("hi"), F.least(left, right).alias("lo"))
    stars = staged(pairs.distinct(), "links")
    before = _mark(stars)
    while True:
        tasks = 1 + before[0] // LINKS
        turned = _small_star(_large_star(stars, tasks), tasks)
        after = _mark(turned)
        drop_staged(stars)
        stars = turned
        if after == before:
            return stars.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        before = after


def _mark(stars: DataFrame) -> tuple:
    """Size and an order-free digest of the links: equal for two rounds only if nothing moved."""
    return tuple(stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")), F.bit_xor(F.xxhash64("lo", "hi"))).first())


def _large_star(stars: DataFrame, tasks: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours.

    The links of a node with many neighbours are dealt to slots by their number, and its smallest neighbour is copied to them.
    """
    both = stars.select(F.explode(F.array(F.struct(F.col("hi").alias("n"), F.col("lo").alias("m")), F.struct(F.col("lo").alias("n"), F.col("hi").alias("m")))).alias("e")).select("e.n", "e.m")
    least = both.groupBy("n").agg(F.min("m").alias("least"), F.count(F.lit(1)).alias("held"))
    least = staged(least.select("n", F.least("n", "least").alias("least"), "held"), "least", tasks)
    turned = staged(dealt_join(both, least, ["n"], "held").where("m > n").select(F.col("m").alias("hi"), F.col("least").alias("lo")).distinct(), "stars", tasks)
    drop_staged(least)
    return turned


def _small_star(stars: DataFrame, tasks: int) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = staged(stars.groupBy("hi").agg(F.min("lo").alias("least"), F.count(F.lit(1)).alias("held")), "least", tasks)
    moved = dealt_join(stars, least, ["hi"], "held").where("lo != least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
    turned = staged(moved.union(least.select("hi", F.col("least").alias("lo"))).distinct(), "stars", tasks)
    drop_staged(least)
    drop_staged(stars)
    return turned
