"""Quality rules judged per document and per host.

A document fails the base rules by itself. Besides, the failures of every rule are
counted per host, the failing share is shrunk towards the corpus by an empirical
beta prior, and a host whose shrunk share is too high takes its documents with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import dealt_join, packed, staged, text_or_empty, unpacked, words_of

#: Rules counted per host; each is a failure of one document.
RULES = ("short", "repeats", "symbols", "same_lines")


def with_metrics(docs: DataFrame, text: str, host: str, min_words: int, without: tuple[str, ...] = ()) -> DataFrame:
    """``own`` (the documents' columns), ``_host``, the metrics and ``failed_rules``. Windows are compared by a 64-bit hash."""
    text_of = text_or_empty(f"`{text}`")
    words = docs.select(packed(docs, *RESULTS, *without), F.col(f"`{host}`").cast("string").alias("_host"), text_of.alias("_text"), words_of(text_of).alias("_words"))
    windows = F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)))
    hashes = F.when(F.size("_words") >= 3, F.slice(windows, 1, F.size("_words") - 2))
    hashed = words.withColumns({"_hashes": hashes, "_lines": F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))})
    repeated = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    ordered = F.when(repeated, F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    starts = F.sort_array(
        F.transform(
            F.filter(
                "_ordered",
                lambda x, j: (x["h"] == F.get("_ordered", j - 1)["h"]) | (x["h"] == F.get("_ordered", j + 1)["h"]),
            ),
            lambda x: x["i"],
        )
    )
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda seen, i: F.struct(i.alias("last"), (seen["n"] + F.least(F.lit(3), i - seen["last"])).alias("n")),
        lambda seen: seen["n"],
    )
    measured = (
        hashed.withColumn("_ordered", ordered)
        .withColumn("_starts", starts)
        .select(
            "own",
            "_host",
            F.size("_words").cast("long").alias("n_words"),
            F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
            F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
            F.size("_lines").cast("long").alias("_n_lines"),
            F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        )
    )
    short = F.col("n_words") < min_words
    repeats = 100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    failures = {
        "short": short,
        "repeats": repeats,
        "symbols": 10 * F.col("n_symbols") > F.col("word_chars"),
        "same_lines": 2 * F.col("n_dup_lines") > F.col("_n_lines"),
    }
    return measured.withColumns(
        {"base_failed": short | repeats, "failed_rules": F.array(*(failures[r].cast("int") for r in RULES))}
    ).drop("_n_lines")


METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
RESULTS = (*METRICS, "host_share", "kept")


def host_verdicts(measured: DataFrame, max_share: float = 0.5) -> DataFrame:
    """Per host and rule ``_host, rule, n, failures, share`` (shrunk) and ``rejected``; a null host is one host.

    The prior of a rule has the corpus share as its mean; its strength follows from the
    spread of the hosts' shares beyond what chance gives. Without such spread (one host,
    equal shares) the strength is a million documents.
    """
    counted = measured.groupBy("_host").agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(F.get("failed_rules", F.lit(k))).alias(r) for k, r in enumerate(RULES))
    )
    hosts = counted.unpivot(["_host", "n"], list(RULES), "rule", "failures")
    total = hosts.groupBy("rule").agg(
        F.count(F.lit(1)).alias("h"),
        F.sum("n").alias("docs"),
        F.sum("failures").alias("failed"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("n2"),
        F.sum(F.col("failures").cast("double") * F.col("failures") / F.col("n")).alias("f2"),
    )
    mean = F.col("failed") / F.col("docs")
    chance = mean * (1 - mean)
    beyond = F.col("f2") - F.col("failed") * mean - (F.col("h") - 1) * chance
    spread = F.try_divide(beyond, F.col("docs") - F.col("n2") / F.col("docs"))
    strength = F.when((spread > 0) & (chance > 0), F.greatest(F.lit(1.0), F.least(F.lit(1e6), chance / spread - 1))).otherwise(1e6)
    prior = total.select("rule", mean.alias("mean"), strength.alias("strength"))
    share = (F.col("failures") + F.col("mean") * F.col("strength")) / (F.col("n") + F.col("strength"))
    return hosts.join(prior, "rule").select("_host", "rule", "n", "failures", share.alias("share"), (share > max_share).alias("rejected"))


def host_rules(docs: DataFrame, text: str = "text", host: str = "source", min_words: int = 50, max_share: float = 0.5, with_text: bool = True, sent: int = 1 << 26) -> DataFrame:
    """All columns of ``docs`` with the metrics, ``host_share`` (highest shrunk share of the host) and ``kept``.

    Every row gets a verdict, repeated rows and null ids included; an empty table gives an empty result. A null or
    empty text has no words and fails as too short. Columns named like the results are replaced. Without ``with_text`` the
    text is left out of the result, and of what is stored on the way. Verdicts of up to ``sent`` bytes of host names are
    sent to the tasks, so that no text is shuffled; more are joined, hosts of many rows in slots.
    """
    without = () if with_text else (text,)
    measured = staged(with_metrics(docs, text, host, min_words, without), "hostrules")
    verdict = host_verdicts(measured, max_share).groupBy("_host").agg(F.max("share").alias("host_share"), F.max("rejected").alias("_rejected"), F.max("n").alias("held"))
    verdict = staged(verdict, "verdicts")
    bytes_of = verdict.agg(F.sum(F.coalesce(F.octet_length("_host"), F.lit(0)) + 32)).first()[0] or 0
    if bytes_of <= sent:
        named = F.broadcast(verdict.select(F.col("_host").alias("h"), "host_share", "_rejected"))
        judged = measured.join(named, F.col("_host").eqNullSafe(F.col("h")), "left")
    else:
        judged = dealt_join(measured, verdict, ["_host"], "held")
    return judged.select(*unpacked(docs, *RESULTS, *without), *METRICS, "host_share", (~F.col("base_failed") & ~F.coalesce("_rejected", F.lit(False))).alias("kept"))
