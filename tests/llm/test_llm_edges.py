"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator and stage."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from indicata.llm import decontaminate, hostrules, htmltext, licenses, linededup, mixing, quality, simhash, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = " ".join(f"word{k} stands here" for k in range(40))
CLASHING = ["own", "_text", "_words", "kept", "n_words", "size", "copies", "score", "_host", "_own", "slot", "coverage", "a.b", "with space", "text2", "n_removed", "labels"]


def documents(spark):
    rows = [
        (1, PROSE, "en", "a", 1),
        (2, PROSE, "en", "a", 1),
        (2, PROSE, "en", "a", 1),
        (3, None, None, None, None),
        (4, "", "de", "b", 0),
        (None, PROSE + " more", None, "b", 5),
        (5, "x\n\n \t\n" + PROSE + "\n" + PROSE.upper(), "fr", None, 7),
        (6, "lonely", "es", "c", 6),
        (7, "deep " * 60_000, "en", "c", 300_000),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    spark.createDataFrame([(1, PROSE.split("word9")[0]), (2, None), (None, "x"), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 1), (4, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def benchmark(spark):
    return spark.createDataFrame([(1, PROSE), (2, None), (None, "x"), (3, "")], "item_id long, text string")


OPERATORS = {
    "quality": lambda s, d: quality.quality(d, labels(s)),
    "mixing": lambda s, d: mixing.mix(d),
    "line dedup": lambda s, d: linededup.dedup_lines(d),
    "host rules": lambda s, d: hostrules.host_rules(d),
    "toxicity": lambda s, d: toxicity.toxicity(d, labels(s)),
    "simhash": lambda s, d: simhash.simhash_groups(d),
    "decontaminate": lambda s, d: decontaminate.decontaminate(d, benchmark(s)),
    "licenses": lambda s, d: licenses.license_scan(d),
    "html": lambda s, d: htmltext.main_text(d.withColumnRenamed("text", "html")),
    "warc": lambda s, d: warc.archived(d.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.col("text").alias("html"))),
}


def clashing(docs):
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_for_every_row(spark, name):
    assert OPERATORS[name](spark, documents(spark)).count() == 9


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, documents(spark).where("false")).collect() == []


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_clashing_names(spark, name):
    plain, clashed = (OPERATORS[name](spark, d) for d in (documents(spark), clashing(documents(spark))))
    results = [c for c in plain.columns if c not in ("doc_id", "text", "lang", "source", "n_chars") or name == "html" and c in ("text", "n_chars")]
    read = lambda df: sorted((str(tuple(r)) for r in df.select(*(F.col(f"`{c}`") for c in results)).collect()))
    assert read(plain) == read(clashed)
    if "own" in clashed.columns:
        assert {r[0] for r in clashed.select(F.col("`a.b`")).collect()} == {"own a.b"}


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stage_takes_odd_rows(spark, tables, stage):
    function = dict(corpus_pipeline.STAGES)[stage]
    docs = clashing(documents(spark))
    found = function(spark, docs, tables)
    if stage != "source mix":
        assert found.columns == docs.columns
    assert found.count() <= 9
    assert function(spark, docs.where("false"), tables).collect() == []


def test_null_text_verdicts(spark):
    docs = documents(spark)
    assert {tuple(r) for r in hostrules.host_rules(docs).where("doc_id in (3, 4)").select("n_words", "base_failed", "kept").collect()} == {(0, True, False)}
    assert [tuple(r) for r in simhash.simhash_groups(docs).where("doc_id in (3, 4)").orderBy("doc_id").collect()] == [(3, 0, 3), (4, 0, 3)]
    assert {tuple(r) for r in mixing.mix(docs).where("doc_id in (3, 4)").select("size", "taken").collect()} == {(0, 0)}
