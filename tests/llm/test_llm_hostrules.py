from pyspark.sql import functions as F

from indicata.llm.hostrules import host_rules, host_verdicts, with_metrics


def measures(text):
    words = text.split()
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if line.split()]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_metrics_match_plain_counts(spark):
    texts = ["", " \t\n", "a", "a a a a", "a b c a b c d", "é b\n\né b\n# $\n# $ ", "\x0bx y z\x0cx y z x y z\r", "one two three " * 50, "q|w <e> &\n q|w <e> &"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit("s"))
    found = host_rules(docs).orderBy("doc_id").select("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
    assert [tuple(r) for r in found] == [measures(t) for t in texts]


def corpus(spark):
    good = " ".join(f"w{k}" for k in range(60))
    rows = [(k, good, "clean") for k in range(60)] + [(100 + k, "short", "broken") for k in range(40)] + [(200 + k, good, "broken") for k in range(3)]
    return spark.createDataFrame(rows + [(300, good, "tiny"), (301, "short", "tiny"), (400, good, None)], "doc_id long, text string, source string")


def test_a_failing_host_takes_its_documents_along(spark):
    kept = {r["doc_id"]: r["kept"] for r in host_rules(corpus(spark)).collect()}
    assert all(kept[k] for k in range(60)) and kept[400]
    assert not any(kept[200 + k] for k in range(3))


def test_small_hosts_shrink_to_the_corpus_share(spark):
    shares = {(r["_host"], r["rule"]): r for r in host_verdicts(with_metrics(corpus(spark), "text", "source", 50)).collect()}
    tiny = shares["tiny", "short"]
    overall = 41 / 106
    assert tiny["failures"] / tiny["n"] == 0.5 and overall < tiny["share"] < 0.5
    assert shares["broken", "short"]["rejected"] and not shares["clean", "short"]["rejected"]


def test_one_host_has_the_corpus_share(spark):
    docs = corpus(spark).where("source = 'broken'")
    share = [r["share"] for r in host_verdicts(with_metrics(docs, "text", "source", 50)).where("rule = 'short'").collect()]
    assert abs(share[0] - 40 / 43) < 1e-9


def test_verdicts_sent_and_joined_are_the_same(spark):
    docs = corpus(spark)
    read = lambda df: sorted(map(str, df.collect()))
    assert read(host_rules(docs)) == read(host_rules(docs, sent=0))
    assert "text" not in host_rules(docs, with_text=False).columns and host_rules(docs, with_text=False).count() == docs.count()
