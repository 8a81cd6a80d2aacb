import corpus_pipeline
from check_oracles import compare, duck

from indicata.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_queries_match_sql(spark):
    connection = duck(SF)
    for name, sql in ORACLES.items():
        outcome = compare(spark, connection, name, QUERIES[name], sql, SF)
        assert outcome.startswith("ok") and "types" not in outcome, (name, outcome)


def test_pipeline_keeps_clean_documents_and_drops_the_rest(spark, tmp_path):
    prose = lambda tag: "\n".join(" ".join(f"{tag}{line}x{k}" for k in range(30)) for line in range(4))
    item = " ".join(f"question{k}" for k in range(30))
    long = prose("copied")
    rows = [(k, prose(f"clean{k}"), "en", f"s{k % 3}", 1) for k in range(12)]
    rows += [(20, long, "en", "s0", 1), (21, long, "en", "s1", 1), (22, long + " tail", "en", "s2", 1)]
    rows += [(30, "too short", "en", "s0", 1), (31, prose("leak") + "\n" + item, "en", "s1", 1), (32, "again and again " * 40, "en", "s2", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(range(12)) | {20} <= found
    assert not found & {21, 30, 31, 32}


def test_near_copies_keep_one_row_of_every_group(spark):
    """Rows of one id with different words, equal rows, copies of other ids and rows without an id, against a plain choice."""
    words = lambda tag, n=60: " ".join(f"{tag}{k}" for k in range(n))
    rows = [(1, words("a")), (1, words("b")), (2, words("a")), (2, words("a")), (3, words("b")), (None, words("b")), (None, words("c")), (None, words("c")), (4, words("d")), (4, words("d")), (5, None), (6, "")]
    docs = spark.createDataFrame([(d, t, "en", "s", k) for k, (d, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    found = dict(corpus_pipeline.STAGES)["near copies"](spark, docs, "")
    assert sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str) == sorted([(1, words("a")), (1, words("b")), (None, words("c")), (4, words("d")), (5, None)], key=str)
    assert found.columns == docs.columns


def test_a_stage_drops_what_the_one_before_stored(spark, tmp_path):
    prose = lambda tag: "\n".join(" ".join(f"{tag}{line}x{k}" for k in range(30)) for line in range(4))
    docs = spark.createDataFrame([(k, prose(f"d{k}"), "en", "s", 1) for k in range(5)], "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    stages["quality rules"](spark, docs, "").write.parquet(f"{tmp_path}/one")
    made = list(corpus_pipeline._spent)
    exists = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(p))
    assert made and any(exists(p) for p in made)
    assert stages["line dedup"](spark, spark.read.parquet(f"{tmp_path}/one"), "").count() == 5
    assert not any(exists(p) for p in made)
    lazy = stages["line dedup"](spark, docs, "")
    assert stages["near copies"](spark, lazy, "").count() == 5
