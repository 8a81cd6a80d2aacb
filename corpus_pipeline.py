"""From raw documents to a training mix: quality rules, line dedup, near copies, benchmark items, source weights.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents its predecessor kept. All but the last
return the columns of ``documents``; the last tells how often each document is taken.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.llm.decontaminate import decontaminate
from indicata.llm.hostrules import host_rules
from indicata.llm.linededup import dedup_lines
from indicata.llm.mixing import mix
from indicata.llm.shared import WORD, columns, dealt_join, drop_staged, drop_unread, noted_paths, staged, table, text_or_empty, unpacked
from indicata.llm.simhash import simhash_components

#: Numbers of documents that are sent to the tasks at most.
SENT = 1 << 20


def _as(docs: DataFrame, found: DataFrame) -> DataFrame:
    return found.select(*columns(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host passes.

    Null and empty texts fail, repeated rows share their verdict, a null source is a host, an empty table stays empty.
    """
    return _as(docs, host_rules(docs).where("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines; one whose words all stand elsewhere goes, others keep at least a word."""
    cleaned = dedup_lines(docs).where((F.col("n_removed") == 0) | F.col("text").rlike(WORD))
    chars = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return _as(docs, cleaned.withColumn("n_chars", chars))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies: that with the smallest id (null last), then text hash; of equal rows one.

    Rows that share an id but not their words are in groups of their own. What goes, and what stands several times, is
    a list of numbers; up to ``SENT`` of them are sent to the tasks, so that no text is shuffled.
    """
    groups = staged(simhash_components(docs, shingle=3, max_bits=2).select("doc_id", "body", "root"), "near")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "body")
    first = groups.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("held"))
    each = groups.groupBy("doc_id", "body", "root").agg(F.count(F.lit(1)).alias("copies"))
    marked = dealt_join(staged(each, "near"), first, ["root"], "held").withColumn("stays", order.eqNullSafe(F.col("first")))
    told = staged(marked.where("NOT stays OR copies > 1").select(F.col("doc_id").alias("_doc"), F.col("body").alias("_body"), "stays"), "near")
    few = told.count() <= SENT
    rows = docs.select(F.struct(*columns(docs)).alias("own"), F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text_or_empty("text")).alias("_text"))
    joined = rows.join(F.broadcast(told) if few else told, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_text") == F.col("_body")), "left")
    kept = joined.where("stays IS NULL").select("own")
    if not told.where("stays").isEmpty():
        kept = kept.union(joined.where("stays").groupBy("_id", "_text").agg(F.first("own").alias("own")).select("own"))
    return kept.select(*unpacked(docs))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; repeated rows are judged alike."""
    return _as(docs, decontaminate(docs, table(spark, sf_dir, "benchmark")).where(~F.col("contaminated")))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often every document is taken so that the sources meet their weights.

    One row for each row, repeated ones and those without id included; a null text is taken for no words, a null source comes last.
    """
    return mix(docs)


def _stage(function: Callable, first: bool = False) -> Callable:
    """The stage, after what the one before has stored on its way is deleted: its result has been written by then.

    Tables that ``docs`` still reads stay, and those of a run that is over until the application ends.
    """

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not first:
            drop_unread(spark, _spent, docs)
        with noted_paths() as made:
            result = function(spark, docs, sf_dir)
        _spent[:] = made
        return result

    return run_stage


_spent: list[str] = []
STAGES = [
    ("quality rules", _stage(quality_rules, first=True)),
    ("line dedup", _stage(line_dedup)),
    ("near copies", _stage(near_dedup)),
    ("benchmark items", _stage(benchmark_free)),
    ("source mix", _stage(source_mix)),
]

#: Edit similarity groups, fingerprints and tilings are beyond SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES[:-1]):
        done = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if number:
            drop_staged(docs)
        docs = done
    return STAGES[-1][1](spark, docs, sf_dir)
