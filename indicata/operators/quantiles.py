"""Exact quantiles with linear interpolation, without gathering a column in one task.

The wanted ranks are closed in on: a bounded sketch gives a bracket around each, a count
says how many rows lie below and inside it, and the open interval between its ends takes
the place of the column until it holds few rows, which are then ranked. Each round is two
scans of one column without a shuffle of rows, and shrinks the interval to a fixed share of
its rows, so a trillion values take four rounds. Values that repeat without bound end up as
bracket ends and are answered by counting alone. Tables of every size go this way.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Rows of an interval that are ranked at last; any value gives the same result.
RANKED = 1_000
SKETCH_ACCURACY = 1_000
# Fraction of the rows by which a bracket reaches beyond the wanted rank on either side.
SLACK = 2.0 / SKETCH_ACCURACY


@dataclass
class _Target:
    """One wanted rank (0-based) of one column and the open interval it lies in."""

    column: str
    rank: int
    rows: int
    low: float | None = None
    high: float | None = None
    below: int = 0
    found: float | None = None
    bracket: tuple[float, float] | None = None

    def value(self) -> Column:
        return F.col(f"`{self.column}`").cast("double")

    def inside(self) -> Column:
        inside = self.value().isNotNull()
        if self.low is not None:
            inside = inside & (self.value() > self.low)
        if self.high is not None:
            inside = inside & (self.value() < self.high)
        return inside


def approximate_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], accuracy: int = 10_000
) -> dict[str, dict[float, float | None]]:
    """Quantiles from a bounded sketch: one scan, rank error at most 1/accuracy."""
    row = df.agg(
        *[
            F.percentile_approx(F.col(f"`{c}`").cast("double"), list(map(float, qs)), accuracy).alias(f"q{i}")
            for i, (c, qs) in enumerate(wanted.items())
        ]
    ).first()
    return {
        c: dict(zip(qs, row[i] if row[i] is not None else [None] * len(qs)))
        for i, (c, qs) in enumerate(wanted.items())
    }


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], small: int = RANKED
) -> dict[str, dict[float, float | None]]:
    """``{column: {fraction: value}}``; nulls do not count, an empty column gives ``None``.

    Reads ``df`` at least twice, so hand it a stored table.
    """
    columns = list(wanted)
    if not columns:
        return {}
    sizes, brackets = _first_look(df, wanted)

    targets: dict[tuple[str, int], _Target] = {}
    for column, fractions in wanted.items():
        for fraction in fractions:
            for rank in _neighbours(fraction, sizes[column]):
                targets[column, rank] = _Target(column, rank, sizes[column], bracket=brackets[column, fraction])
    pending = list(targets.values())
    while pending:
        large = [t for t in pending if t.rows > small]
        if not large:
            _pick(df, pending)
            break
        _narrow(df, large)
        pending = [t for t in pending if t.found is None]

    result: dict[str, dict[float, float | None]] = {}
    for column, fractions in wanted.items():
        result[column] = {}
        for fraction in fractions:
            ranks = _neighbours(fraction, sizes[column])
            if not ranks:
                result[column][fraction] = None
                continue
            low, high = (targets[column, r].found for r in (ranks[0], ranks[-1]))
            part = fraction * (sizes[column] - 1) - ranks[0]
            result[column][fraction] = (1.0 - part) * low + part * high if part > 0 else low
    return result


def _first_look(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> tuple[dict, dict]:
    """Rows per column, and a bracket for every wanted fraction, from one scan."""
    ends = [(c, q) for c, qs in wanted.items() for q in qs]
    row = df.agg(
        *[F.count(F.col(f"`{c}`")) for c in wanted],
        *[_sketch(F.col(f"`{c}`").cast("double"), q) for c, q in ends],
    ).first()
    sizes = dict(zip(wanted, row[: len(wanted)]))
    return sizes, {end: found and tuple(found) for end, found in zip(ends, row[len(wanted) :])}


def _neighbours(fraction: float, size: int) -> list[int]:
    """The ranks that a quantile interpolates between."""
    if size == 0:
        return []
    at = fraction * (size - 1)
    return sorted({math.floor(at), min(math.ceil(at), size - 1)})


def _sketch(value: Column, fraction: float) -> Column:
    """Two values that most likely lie on either side of a fraction."""
    ends = [max(0.0, fraction - SLACK), min(1.0, fraction + SLACK)]
    return F.percentile_approx(value, ends, SKETCH_ACCURACY)


def _narrow(df: DataFrame, targets: list[_Target]) -> None:
    """One round: bracket every target by a sketch, then count around the bracket."""
    unseen = [t for t in targets if t.bracket is None]
    if unseen:
        fractions = [(t.rank - t.below) / max(t.rows - 1, 1) for t in unseen]
        found = df.agg(*[_sketch(F.when(t.inside(), t.value()), q) for t, q in zip(unseen, fractions)]).first()
        for t, ends in zip(unseen, found):
            t.bracket = tuple(ends)
    brackets = [t.bracket for t in targets]

    around = []
    for i, (t, (low, high)) in enumerate(zip(targets, brackets)):
        value, inside = t.value(), t.inside()
        for name, test in (
            ("under", value < low),
            ("at_low", value == low),
            ("at_high", value == high),
            ("over", value > high),
        ):
            around.append(F.count_if(inside & test).alias(f"{name}{i}"))
    row = df.agg(*around).first()
    for i, (t, (low, high)) in enumerate(zip(targets, brackets)):
        under, at_low, at_high, over = (row[f"{n}{i}"] for n in ("under", "at_low", "at_high", "over"))
        t.bracket = None
        rank = t.rank - t.below
        if rank < under:  # the sketch missed: the rank lies left of the bracket
            t.high, t.rows = low, under
        elif rank < under + at_low:
            t.found = low
        elif rank >= t.rows - over:  # or right of it
            t.low, t.below, t.rows = high, t.below + t.rows - over, over
        elif rank >= t.rows - over - at_high:
            t.found = high
        else:
            between = t.rows - under - over - at_low - at_high
            t.below += under + at_low
            t.low, t.high, t.rows = low, high, between


def _pick(df: DataFrame, targets: list[_Target]) -> None:
    """Read off the ranks of intervals that hold few rows."""
    candidates = F.array(
        *[F.when(t.inside(), F.struct(F.lit(i).alias("target"), t.value().alias("value"))) for i, t in enumerate(targets)]
    )
    rows = df.select(F.explode(F.filter(candidates, lambda c: c.isNotNull())).alias("c")).select("c.*")
    wanted = F.create_map(*[F.lit(v) for i, t in enumerate(targets) for v in (i, t.rank - t.below + 1)])
    ranked = rows.withColumn("place", F.row_number().over(Window.partitionBy("target").orderBy("value")))
    for target, value in ranked.where(F.col("place") == wanted[F.col("target")]).select("target", "value").collect():
        targets[target].found = value
