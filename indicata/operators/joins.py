"""Left equi-joins on the territory key.

No side is broadcast by hint: Spark broadcasts what it measures to be below its
own threshold and sort-merges the rest, and silver tables that were aggregated
on the key are already partitioned by it, so a chain of joins on that key adds
no shuffle; tables stored in buckets of the key need none either. A key that holds a
large share of a table is the case a sort-merge join cannot spread by itself;
``fold_left_spread`` deals those rows out. Which keys these are is known from a sketch
of frequent items that any write of the table can take along.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.storage import staged

#: Rows of one key that a task may be left with; a key with more is dealt to as many slots as that takes.
ROWS_PER_TASK = 1_000_000
#: Items a sketch keeps, and how many of them it reports. With n rows a sketch is off by 2.7 n / TRACKED at most; a key of
#: more than twice that is certain to be reported, and no more keys than OFTEN can have so many rows.
TRACKED, OFTEN = 8192, 2048


@dataclass(frozen=True)
class KeyCounts:
    """What a sketch knows of a table's keys: the rows with a key, and the frequent ones with their counts."""

    rows: int
    often: dict

    @staticmethod
    def of(row) -> KeyCounts:
        """From the values of ``key_columns``."""
        return KeyCounts(row["key_rows"], {i["item"]: i["count"] for i in row["key_often"] or () if i["item"] is not None})


def key_columns(key: str) -> list[Column]:
    """Aggregates that count a key's frequent values; they can be observed while a table is written."""
    return [F.count(f"`{key}`").alias("key_rows"), F.expr(f"approx_top_k(`{key}`, {OFTEN}, {TRACKED})").alias("key_often")]


def key_counts(tables: Sequence[DataFrame], key: str) -> list[KeyCounts]:
    """The sketches of tables that come without, from one job that reads all of them."""
    found = [t.agg(*key_columns(key)).withColumn("table", F.lit(i)) for i, t in enumerate(tables)]
    return [KeyCounts.of(r) for r in sorted(reduce(DataFrame.unionByName, found).collect(), key=lambda r: r["table"])]


def keyed(df: DataFrame, key: str, to: str = "string") -> DataFrame:
    """Cast the key; done in silver so that both sides of every join agree on its type."""
    return df.withColumn(key, F.col(f"`{key}`").cast(to))


def split_null_keys(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows that can be joined, and the rejects whose key is missing."""
    return df.where(f"`{key}` IS NOT NULL"), df.where(f"`{key}` IS NULL")


def fold_left(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Left-join the tables onto the first one, in order. Duplicate keys multiply rows."""
    return reduce(lambda left, right: left.join(right, key, "left"), tables)


def hot_slots(tables: Sequence[DataFrame], key: str, rows_per_task: int = ROWS_PER_TASK, counts: Sequence[KeyCounts] | None = None) -> DataFrame | None:
    """The keys with more than ``rows_per_task`` rows in any table, and the slots of each table: ``key, s0, s1, ...``.

    They are read off the sketches (``counts``; taken in a job over all tables if not given), which makes them a
    bounded list; None if there are none.
    """
    counts = key_counts(tables, key) if counts is None else counts
    hot = sorted({k for c in counts for k, n in c.often.items() if n > rows_per_task})
    if not hot:
        return None
    slots = [(k, *(max(1, -(-c.often.get(k, 0) // rows_per_task)) for c in counts)) for k in hot]
    kind = tables[0].schema[key].dataType.simpleString()
    return tables[0].sparkSession.createDataFrame(slots, f"`{key}` {kind}, " + ", ".join(f"s{j} int" for j in range(len(tables))))


def _dealt(df: DataFrame, key: str, slot: str, copies: str, slots: str, columns: list[str]) -> DataFrame:
    """Equal rows collapsed to one row with a count, the counts of a key dealt to the number of slots in ``slots``.

    Slots follow from the row's content alone, so a recomputed task deals alike.
    """
    names = [F.col(f"`{c}`") for c in columns]
    collapsed = df.groupBy(*(F.col(f"`{c}`") for c in df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    size, turn = F.col(slots), F.col("_t")
    share = F.floor(F.col("_n") / size) + F.when(turn < F.col("_n") % size, 1).otherwise(0)
    return (
        collapsed.withColumn("_hash", F.xxhash64(*names))
        .withColumn("_t", F.explode(F.sequence(F.lit(0), F.least("_n", size).cast("int") - 1)))
        .withColumns({slot: F.pmod(F.pmod("_hash", size) + turn, size).cast("int"), copies: share})
        .drop("_n", "_hash", "_t")
    )


def _copied(df: DataFrame, slot: str, slots: str) -> DataFrame:
    """Each row once per slot that the other side has for its key."""
    return df.withColumn(slot, F.explode(F.sequence(F.lit(0), F.col(slots) - 1)))


def _repeated(df: DataFrame, count: Column, block: int = 4096) -> DataFrame:
    """Each row ``count`` times, in two steps so that no row carries a long array."""
    blocks = F.sequence(F.lit(0), F.floor((F.col("_count") - 1) / block))
    rest = F.least(F.lit(block), F.col("_count") - F.col("_block") * block).cast("int")
    return (
        df.withColumn("_count", count)
        .withColumn("_block", F.explode(blocks))
        .withColumn("_one", F.explode(F.sequence(F.lit(1), rest)))
        .drop("_count", "_block", "_one")
    )


def _dealt_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join of tables that hold hot keys only and carry ``_ls`` and ``_rs``, the slots of either side.

    Equal rows are collapsed to counts; the rows of a key are dealt to the slots of their
    own side and copied to those of the other. A key without partner gets one empty one,
    so that the join can be an inner join.
    """
    mine, theirs = [c for c in left.columns if c not in ("_ls", "_rs")], [c for c in right.columns if c not in ("_ls", "_rs")]
    lone = left.select(key, "_ls", "_rs").distinct().join(right.select(key).distinct(), key, "left_anti")
    right = right.unionByName(lone, allowMissingColumns=True)
    dealt_left = _copied(_dealt(left, key, "_l", "_left_copies", "_ls", mine), "_r", "_rs")
    dealt_right = _copied(_dealt(right, key, "_r", "_right_copies", "_rs", theirs), "_l", "_ls").drop("_ls", "_rs")
    pairs = dealt_left.join(dealt_right, [key, "_l", "_r"])
    return _repeated(pairs, F.col("_left_copies") * F.col("_right_copies")).drop("_l", "_r", "_ls", "_rs", "_left_copies", "_right_copies")


def fold_left_spread(tables: Sequence[DataFrame], key: str, rows_per_task: int = ROWS_PER_TASK, counts: Sequence[KeyCounts] | None = None) -> DataFrame:
    """``fold_left`` that stays balanced when a key holds much of any table.

    The hot keys of all tables - a bounded table - are set apart once. The rest is the
    plain chain of joins; the rows of hot keys go through ``_dealt_join``, with slots by
    their number, and are stored after every step, as each step reads them more than once.
    Without hot keys this is ``fold_left``. Only without ``counts`` are the tables read to look for them.
    """
    hot = hot_slots(tables, key, rows_per_task, counts)
    if hot is None:
        return fold_left(tables, key)
    hot = F.broadcast(hot)  # at most OFTEN rows a table
    plain = fold_left([t.join(hot.select(key), key, "left_anti") for t in tables], key)
    joined = staged(tables[0].join(hot.select(key), key, "left_semi"), "hot")
    wide = F.lit(1)
    for j, right in enumerate(tables[1:], 1):
        # Rows of a key multiply along the chain, and so do the slots of its left side.
        wide = F.least(F.lit(1 << 20), wide * F.col(f"s{j - 1}").cast("bigint"))
        slots = hot.select(key, wide.cast("int").alias("_ls"), F.col(f"s{j}").alias("_rs"))
        joined = _dealt_join(joined.join(slots, key), staged(right.join(slots, key), "hot"), key)
        joined = staged(joined, "dealt") if j + 1 < len(tables) else joined
    return plain.unionByName(joined)


def left_join_spread(left: DataFrame, right: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    return fold_left_spread([left, right], key, rows_per_task)
