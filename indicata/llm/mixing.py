"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the copies it is expected to have in the mix. Rates start at
one and are tilted exponentially by the document's words, as little as possible in
relative entropy between 0 and the largest rate, so that the words of every source meet
its target. The tilts solve a convex dual with one equation a source; Newton steps for all
sources run as aggregates over counts of documents by source and size. Rates are rounded
to whole copies along the sizes, which keeps each source within a document of its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import drop_staged, staged, text_or_empty, words_of

#: Rates are rounded in millionths, so sums of them are exact and reruns agree.
UNIT = 1_000_000
#: Bounds of a tilt, per mean document of the source.
STEEPEST = 1000.0


def sized(docs: DataFrame, text: str = "text") -> Column:
    """Words of a text; a null text has none."""
    return F.size(words_of(text_or_empty(f"`{text}`"))).cast("long")


def source_targets(rows: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, n, source_size, target`` of every source of ``rows`` (``source, size``).

    Sources in code-point order, null last, take the weights in turn. A target stops at ``most`` times the
    source's words; what is left over goes to the others by weight until none is above.
    """
    sums = rows.groupBy("source").agg(F.count_if(F.col("size") > 0).alias("n"), F.sum("size").alias("source_size"))
    ordered = staged(sums.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources")
    before = ordered.groupBy("part").count().select(F.col("part").alias("p"), (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1 + F.col("before")
    placed = ordered.join(before, F.col("part") == F.col("p"))
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights)).cast("int"))
    weighed = staged(placed.select("source", "n", "source_size", weight.alias("weight")), "weighed")
    total, all_weights = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    goal = share * (total or 0)
    level, before_level = goal / (all_weights or 1.0), None
    most_of = most * F.col("source_size")
    while level != before_level:
        above = F.col("weight") * level > most_of
        stopped, free = weighed.agg(F.sum(F.when(above, most_of).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight")))).first()
        before_level = level
        level = (goal - stopped) / free if free else level
    return weighed.select("source", "n", "source_size", F.least(most_of.cast("double"), F.col("weight") * level).alias("target"))


def _rate(size: Column, mean: Column, tilt: Column, most: float) -> Column:
    """The bounded rate: one without tilt, towards ``most`` or zero with it."""
    z = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), tilt * size / mean))
    return most / (1 + (most - 1) * F.exp(-z))


def tilts(counts: DataFrame, targets: DataFrame, most: float = 2.0, tolerance: float = 1e-6, steps: int = 200) -> DataFrame:
    """``targets`` with ``mean`` words of a document and ``tilt``, null where every document is taken ``most`` times.

    ``counts`` has ``source, size, n``. Each step is Newton's, or halves the bracket where that leaves it.
    """
    mean = F.greatest(F.lit(1.0), F.col("source_size") / F.greatest(F.lit(1), F.col("n")))
    start = F.when(F.col("target") < most * F.col("source_size"), 0.0)
    state = staged(targets.select("*", mean.alias("mean"), start.alias("tilt"), F.lit(-STEEPEST).alias("lo"), F.lit(STEEPEST).alias("hi"), F.lit(False).alias("met")), "tilts")
    sizes = counts.select(F.col("source").alias("s"), "size", F.col("n").alias("docs"))
    for _ in range(steps):
        if state.where("tilt IS NOT NULL AND NOT met").isEmpty():
            return state.select(*targets.columns, "mean", F.round("tilt", 9).alias("tilt"))
        rate = _rate(F.col("size"), F.col("mean"), F.col("tilt"), most)
        words = F.col("docs") * F.col("size")
        now = (
            sizes.join(state.where("tilt IS NOT NULL AND NOT met"), F.col("s").eqNullSafe(F.col("source")))
            .groupBy(F.col("source").alias("s"))
            .agg(F.sum(words * rate).alias("taken"), F.sum(words * F.col("size") / F.col("mean") * rate * (1 - rate / most)).alias("slope"))
        )
        gap = F.col("taken") - F.col("target")
        lo, hi = F.when(gap < 0, F.col("tilt")).otherwise(F.col("lo")), F.when(gap > 0, F.col("tilt")).otherwise(F.col("hi"))
        newton = F.col("tilt") - F.try_divide(gap, F.col("slope"))
        met = (F.abs(gap) <= tolerance * F.col("target")) | (hi - lo < 1e-9)
        stepped = F.when(met, F.col("tilt")).when((newton > lo) & (newton < hi), newton).otherwise((lo + hi) / 2)
        moved = state.join(now, F.col("s").eqNullSafe(F.col("source")), "left")
        fresh = F.col("taken").isNotNull()
        turned = staged(
            moved.select(*targets.columns, "mean", *(F.when(fresh, new).otherwise(F.col(name)).alias(name) for name, new in (("tilt", stepped), ("lo", lo), ("hi", hi), ("met", met)))),
            "tilts",
        )
        drop_staged(state)
        state = turned
    raise ArithmeticError(f"tilts did not meet their targets within {steps} steps")


def copies(rows: DataFrame, tilted: DataFrame, most: float = 2.0, slots: int = 64) -> DataFrame:
    """``rows`` (``doc_id, source, size``) with ``slot, place, source_size, target, copies``.

    Documents of a source stand in order of size. A document gets the whole part of its rate and one more copy
    wherever the running sum of the fractions passes a whole number, so the words rounded away and rounded up
    cancel out. Running sums are taken over sizes, then slots, then the documents of a slot.
    """
    dealt = rows.withColumn("slot", F.pmod(F.xxhash64("doc_id"), F.lit(slots)).cast("int"))
    cells = dealt.groupBy("source", "size", "slot").agg(F.count(F.lit(1)).alias("docs"))
    sizes = cells.groupBy("source", "size").agg(F.sum("docs").alias("docs"))
    state = tilted.select(F.col("source").alias("s"), "source_size", "target", "mean", "tilt")
    rate = F.when(F.col("tilt").isNull(), F.lit(int(most * UNIT))).otherwise(F.round(_rate(F.col("size"), F.col("mean"), F.col("tilt"), most) * UNIT).cast("long"))
    rated = sizes.join(state, F.col("source").eqNullSafe(F.col("s"))).select("source", "size", "docs", "source_size", "target", rate.cast("long").alias("rate"))
    rated = rated.withColumn("part", F.col("rate") % UNIT)
    through = F.sum(F.col("part") * F.col("docs")).over(Window.partitionBy("source").orderBy("size"))
    rated = rated.select(F.col("source").alias("s"), F.col("size").alias("z"), "source_size", "target", "rate", "part", (through - F.col("part") * F.col("docs")).alias("below"))
    within = Window.partitionBy("source", "size").orderBy("slot")
    celled = cells.withColumn("ahead", F.sum("docs").over(within) - F.col("docs")).join(rated, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
    celled = celled.select("s", "z", F.col("slot").alias("t"), "source_size", "target", "rate", "part", (F.col("below") + F.col("part") * F.col("ahead")).alias("below"))
    place = F.row_number().over(Window.partitionBy("source", "size", "slot").orderBy(F.xxhash64("doc_id", "size"), "doc_id"))
    placed = dealt.withColumn("place", place).join(celled, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("slot") == F.col("t")))
    after = F.floor((F.col("below") + F.col("part") * F.col("place") + UNIT // 2) / UNIT)
    until = F.floor((F.col("below") + F.col("part") * (F.col("place") - 1) + UNIT // 2) / UNIT)
    whole = F.floor(F.col("rate") / UNIT) + after - until
    return placed.select("doc_id", "source", "size", "slot", "place", "source_size", "target", whole.cast("long").alias("copies"))


def settled(mixed: DataFrame, most: float = 2.0, rounds: int = 2) -> DataFrame:
    """Turns one copy a source and round, of the document whose words come nearest to what its source lacks or has too many."""
    for _ in range(rounds):
        mixed = staged(mixed, "copies")
        gaps = mixed.groupBy("source").agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
        gaps = gaps.select(F.col("source").alias("s"), "gap")
        free = mixed.groupBy("source", "size").agg(
            F.min(F.when(F.col("copies") < int(most), F.struct("slot", "place"))).alias("more"), F.min(F.when(F.col("copies") > 0, F.struct("slot", "place"))).alias("less")
        )
        pick = F.when(F.col("gap") > 0, F.col("more")).otherwise(F.col("less"))
        useful = free.join(gaps, F.col("source").eqNullSafe(F.col("s"))).withColumn("pick", pick)
        useful = useful.where(F.col("pick").isNotNull() & (F.col("size") > 0) & (F.col("size") < 2 * F.abs("gap")))
        nearest = useful.groupBy("source").agg(F.min(F.struct(F.abs(F.abs("gap") - F.col("size")).alias("off"), "size", "pick", "gap")).alias("b"))
        turns = nearest.select(
            F.col("source").alias("s"), F.col("b.size").alias("z"), F.col("b.pick.slot").alias("t"), F.col("b.pick.place").alias("p"), F.signum("b.gap").cast("long").alias("turn")
        )
        same = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("slot") == F.col("t")) & (F.col("place") == F.col("p"))
        mixed = mixed.join(turns, same, "left").select(*(c for c in mixed.columns if c != "copies"), (F.col("copies") + F.coalesce("turn", F.lit(0))).alias("copies"))
    return mixed


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Per row of ``docs``: ``doc_id, source, size, source_size, target, copies, taken``.

    Empty and null texts have no words and never add to the mix; a null source is a source of its own. Repeated rows
    are rows of their own. An empty table gives an empty mix. ``most`` must be a whole number of copies over one.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"), sized(docs, text).alias("size"))
    rows = staged(rows, "sizes")
    counts = staged(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "counts")
    targets = source_targets(rows, weights, share, most)
    mixed = settled(copies(rows, tilts(counts, targets, most), most), most)
    return mixed.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
