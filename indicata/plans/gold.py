"""Gold: the silver tables joined on the territory code, with ratio and label."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata import names
from indicata.functions import completeness, ratio_fill_zero, ratio_plain
from indicata.operators.columns import reindex
from indicata.operators.joins import ROWS_PER_TASK, KeyCounts, fold_left, fold_left_spread
from indicata.operators.rows import drop_incomplete, sorted_by_key
from indicata.sources.catalogue import JOIN_ORDER


def joined(
    silvers: Mapping[str, DataFrame],
    mode: str = "label",
    repeated_keys: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    counts: Mapping[str, KeyCounts] | None = None,
) -> DataFrame:
    """Left joins onto the base table.

    In ``label`` mode the base is the first source that is there; in ``strict``
    mode it is the population, which must be. Codes that stand often enough to unbalance a join are dealt out if
    they are known: from the sketches taken while the tables were written (``counts``), or, with ``repeated_keys``,
    from reading the tables once more.
    """
    order = [n for n in JOIN_ORDER[mode] if n in silvers]
    if not order:
        raise ValueError("no source could be read")
    if mode == "strict" and order != JOIN_ORDER[mode]:
        raise ValueError(f"strict mode needs every source; missing {set(JOIN_ORDER[mode]) - set(order)}")
    tables = [silvers[n] for n in order]
    if counts is None and not repeated_keys:
        return fold_left(tables, names.CODE)
    return fold_left_spread(tables, names.CODE, rows_per_task, None if counts is None else [counts[n] for n in order])


def finished(table: DataFrame, mode: str = "label") -> DataFrame:
    """Fixed columns, then the ratio, then (label mode) the completeness label.

    Strict mode drops incomplete rows before the ratio exists, so a ratio that is
    infinite or missing stays in the table.
    """
    if mode == "strict":
        table = drop_incomplete(table)
    table = reindex(table, names.GOLD_SCHEMA)
    revenue, gdp = F.col(names.REVENUE), F.col(names.GDP)
    if mode == "strict":
        return table.withColumn(names.BURDEN, ratio_plain(revenue, gdp))
    return table.withColumns(
        {
            names.BURDEN: ratio_fill_zero(revenue, gdp),
            names.STATUS: completeness(F.col(names.INDEX), gdp, revenue),
        }
    )


def gold(
    silvers: Mapping[str, DataFrame],
    mode: str = "label",
    ordered: bool = True,
    repeated_keys: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    counts: Mapping[str, KeyCounts] | None = None,
) -> DataFrame:
    table = finished(joined(silvers, mode, repeated_keys, rows_per_task, counts), mode)
    return sorted_by_key(table, names.CODE) if ordered else table
