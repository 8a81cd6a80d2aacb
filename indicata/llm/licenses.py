"""License statements in documents: exact phrases, and notices found by a set-similarity join.

The notices of ``TEMPLATES`` are sets of words, and so is every line of a document, and
every window over the line breaks that has as many words as the longest notice can spread
to. A line holds a notice if it contains a given share of its words; so does a window, by
the words as many as the notice itself can spread to. Words are put in order of how
many documents have them, rarest first. A line and a notice that overlap enough then share
one of the notice's first words within the line's first words (prefix filter); lines too
short (length filter) and pairs whose remaining words cannot suffice (positional filter)
go before the overlap is counted, so the result is exact.
"""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ascii_lower, packed, staged, text_or_empty, unpacked

# Phrases with their labels, and wordings of widely used license notices.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)

#: What separates words: all ASCII but digits and small letters.
BETWEEN = r"\x00-\x2F\x3A-\x60\x7B-\x7F"


def words_in(text: str) -> list[str]:
    return re.findall(f"[^{BETWEEN}]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))


def template_rows(templates, share: float) -> list[tuple[int, str, list[str], int]]:
    """Number, label, distinct words and the words that must occur."""
    sets = [(label, sorted(set(words_in(text)))) for label, text in templates]
    return [(k, label, words, math.ceil(round(share * len(words), 9))) for k, (label, words) in enumerate(sets)]


def _places(phrase: str) -> Column:
    """Where the phrase starts in ``_words``."""
    first, *rest = phrase.split(" ")
    rarest = max(phrase.split(" "), key=lambda w: (w not in ("under", "the", "by", "version", "license"), len(w)))
    at = F.filter(
        F.sequence(F.lit(0), F.size("_words") - 1),
        lambda i: reduce(lambda a, b: a & b, (F.get("_words", i + k) == w for k, w in enumerate([first, *rest]))),
    )
    return F.when(F.array_contains("_words", rarest), at).otherwise(F.array().cast("array<int>"))


def license_scan(docs: DataFrame, text: str = "text", templates=TEMPLATES, phrases: dict[str, str] = PHRASES, share: float = 0.9) -> DataFrame:
    """All columns of ``docs`` but the text, then ``n_words, n_base, first_word, last_word, base_labels, labels, score``.

    A null text is empty; a document without places has null ``first_word`` and ``last_word``, empty labels and score 0.
    The score is 1 with a phrase, else the largest contained share of a found notice. Rows that repeat, and null ids,
    get results of their own. Columns named like the results are replaced.
    """
    results = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    notices = template_rows(templates, share)
    vocabulary = sorted({w for _, _, words, _ in notices for w in words})
    fewest = min(needed for *_, needed in notices)
    spans = [math.ceil(round(len(words_in(t)) / share, 9)) for _, t in templates]

    spaced = F.regexp_replace(ascii_lower(text_or_empty(f"`{text}`")), f"[{BETWEEN}&&[^\n]]+", " ")
    lines = docs.select(packed(docs, text, *results), spaced.alias("_text"))
    trimmed = F.btrim("_text", F.lit(" \n"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \n]+"))
    known = F.transform(F.split("_text", "\n"), lambda line: F.array_distinct(F.filter(F.split(line, " "), lambda w: w.isin(vocabulary))))
    split = lines.select("*", words.alias("_words"), known.alias("_known"))
    found = split.select(
        "own",
        F.size("_words").cast("long").alias("n_words"),
        *(_places(p).alias(f"_at{k}") for k, p in enumerate(phrases)),
        F.array_distinct(F.flatten("_known")).alias("_seen"),
        F.filter("_known", lambda line: F.size(line) >= fewest).alias("_lines"),
        "_words",
    )
    # Only texts that hold enough of a notice's words anywhere keep their words for the windows.
    enough = reduce(lambda a, b: a | b, (F.size(F.array_intersect("_seen", F.array(*(F.lit(w) for w in words)))) >= needed for _, _, words, needed in notices))
    found = found.withColumn("_words", F.when(enough, F.col("_words")))
    digest = staged(found.withColumn("_row", F.monotonically_increasing_id()), "licenses")

    holders = {r["w"]: r["n"] for r in digest.select(F.explode("_seen").alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most the templates' words
    ordered = sorted(vocabulary, key=lambda w: (holders.get(w, 0), w))
    matched = _joined(digest, notices, ordered, fewest).union(_wrapped(digest, notices, spans, ordered))
    per_row = matched.groupBy("_row").agg(F.collect_set("label").alias("_labels"), F.max("contained").alias("_contained"))

    places = F.concat(*(F.col(f"_at{k}") for k in range(len(phrases))))
    base = F.array_distinct(F.filter(F.array(*(F.when(F.size(f"_at{k}") > 0, F.lit(label)) for k, label in enumerate(phrases.values()))), lambda x: x.isNotNull()))
    rows = digest.drop("_seen", "_lines", "_words").join(per_row, "_row", "left").withColumns({"_places": places, "_base": base})
    every = F.array_distinct(F.concat("_base", F.coalesce("_labels", F.array().cast("array<string>"))))
    return rows.select(
        *unpacked(docs, text, *results),
        "n_words",
        F.size("_places").cast("long").alias("n_base"),
        F.array_min("_places").cast("long").alias("first_word"),
        F.array_max("_places").cast("long").alias("last_word"),
        F.array_join(F.sort_array("_base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(every), ",").alias("labels"),
        F.when(F.size("_base") > 0, 1.0).otherwise(F.coalesce("_contained", F.lit(0.0))).alias("score"),
    )


def _wrapped(digest: DataFrame, notices: list, spans: list[int], ordered: list[str]) -> DataFrame:
    """``_row, label, contained`` for every notice with enough words in a window over the line breaks.

    Such a window holds one of the notice's first words, rarest first, so only the windows around these are looked at.
    """
    rank = {w: k for k, w in enumerate(ordered)}
    index = []
    for (_, label, words, needed), span in zip(notices, spans):
        first = sorted(words, key=rank.__getitem__)[: len(words) - needed + 1]
        index += [(w, label, len(words), needed, span, words) for w in first]
    table = digest.sparkSession.createDataFrame(index, "word string, label string, size int, needed int, span int, words array<string>")
    starts = sorted({row[0] for row in index})
    reach = max(spans) - 1

    texts = digest.where("_words IS NOT NULL").select("_row", "_words")
    at = F.filter(F.sequence(F.lit(0), F.size("_words") - 1), lambda i: F.get("_words", i).isin(starts))
    around = F.transform(at, lambda i: F.struct(F.get("_words", i).alias("word"), F.least(i, F.lit(reach)).alias("at"), F.slice("_words", F.greatest(i - reach, F.lit(0)) + 1, 2 * reach + 1).alias("near")))
    met = texts.select("_row", F.explode(around).alias("p")).select("_row", "p.*").join(F.broadcast(table), "word")  # a few rows per template
    windows = F.sequence(F.greatest(F.col("at") - F.col("span") + 1, F.lit(0)), F.col("at"))
    overlap = F.array_max(F.transform(windows, lambda k: F.size(F.array_intersect(F.slice("near", k + 1, F.col("span")), "words"))))
    return met.withColumn("overlap", overlap).where("overlap >= needed").select("_row", "label", (F.col("overlap") / F.col("size")).alias("contained"))


def _joined(digest: DataFrame, notices: list, ordered: list[str], fewest: int) -> DataFrame:
    """``_row, label, contained`` for every line and notice with enough words in common."""
    spark = digest.sparkSession
    rank = {w: k for k, w in enumerate(ordered)}
    prefixes = []
    for number, label, words, needed in notices:
        sorted_words = sorted(words, key=rank.__getitem__)
        for place, word in enumerate(sorted_words[: len(words) - needed + 1]):
            prefixes.append((word, number, label, place, len(words), needed, sorted_words))
    index = spark.createDataFrame(prefixes, "word string, notice int, label string, place int, size int, needed int, words array<string>")

    lines = digest.select("_row", F.posexplode("_lines").alias("line", "known"))
    lines = lines.select("_row", "line", F.array_intersect(F.array(*(F.lit(w) for w in ordered)), "known").alias("known"))
    prefix = F.slice("known", 1, F.size("known") - fewest + 1)
    probes = lines.select("_row", "line", "known", F.posexplode(prefix).alias("at", "word"))
    left = 1 + F.least(F.size("known") - F.col("at") - 1, F.col("size") - F.col("place") - 1)
    pairs = probes.join(F.broadcast(index), "word").where((F.size("known") >= F.col("needed")) & (left >= F.col("needed")))  # the index has a few rows per template
    overlap = F.size(F.array_intersect("known", "words"))
    return pairs.withColumn("overlap", overlap).where("overlap >= needed").select("_row", "label", (F.col("overlap") / F.col("size")).alias("contained"))
