import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from indicata.llm import htmltext, quality, toxicity


def held_out_scores(query, sf, label):
    found = query.toPandas().set_index("doc_id")
    wanted = duckdb.sql(f"SELECT doc_id, {label} AS y, crc FROM (SELECT *, doc_id % 5 AS crc FROM '{sf}/labels.parquet')").df().set_index("doc_id")
    both = found.join(wanted[["y"]], how="inner")
    return both[both["held_out"]]


SF = "/root/testdata/sf0.01"


def test_quality_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    held = held_out_scores(quality.quality(docs, labels), SF, "quality")
    assert (held["predicted"] == held["y"]).mean() > 0.93
    assert held["score"].between(0, 1).all() and ((held["score"] >= 0.3) == (held["predicted"] == 1)).all()


def test_additive_model_finds_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y, pairs=1)
    assert model.pairs == [(0, 1)]
    assert ((model.scores(x) > 0.5) == y).mean() > 0.9


def test_constant_labels_give_a_constant():
    model = quality.fit(np.zeros((5, 3)), np.ones(5))
    assert len(set(model.scores(np.random.default_rng(0).random((4, 3))).tolist())) == 1
    assert quality.fit(np.zeros((0, 3)), np.zeros(0)).scores(np.zeros((1, 3)))[0] == 0.5


def test_toxic_words_are_learned():
    rng = random.Random(1)
    words = [f"word{k}" for k in range(200)]
    texts, y = [], []
    for k in range(600):
        body = rng.choices(words, k=rng.randint(5, 60))
        y.append(float(k % 4 == 0))
        if y[-1]:
            body.insert(rng.randrange(len(body)), rng.choice(["vile", "rotten"]))
        texts.append(" ".join(body))
    codes = [toxicity.Words().codes(t) for t in texts]
    net = toxicity.fit(codes[:450], np.array(y[:450], np.float32))
    score = toxicity.Scorer(net)
    found = np.array([score(t) >= 0.5 for t in texts[450:]])
    assert (found == (np.array(y[450:]) == 1)).mean() > 0.95
    assert abs(score(texts[0]) - net.score_codes(codes[0])) < 1e-6


def test_blocks_of_a_long_text_give_the_same_score(monkeypatch):
    net = toxicity.Network.fresh(np.random.default_rng(0), (1, 2, 3), 8, 6)
    text = " ".join(f"w{k % 97}" for k in range(1000))
    whole = toxicity.Scorer(net)(text)
    monkeypatch.setattr(toxicity, "BLOCK", 13)
    assert abs(toxicity.Scorer(net)(text) - whole) < 1e-6


def test_thresholds_follow_the_scores():
    scores, y = np.array([0.9, 0.8, 0.3, 0.2]), np.array([1.0, 1, 0, 0])
    assert 0.3 < toxicity.best_threshold(scores, y, weight=0) < 0.8
    assert toxicity.best_threshold(scores, np.zeros(4)) == 0.5


def test_cuts_of_a_table_follow_the_plain_ones(spark):
    rng = np.random.default_rng(3)
    rows = [(rng.choice(["en", "de", "xx"]), float(np.round(rng.beta(0.3, 0.6), 3))) for _ in range(900)] + [(None, 0.0), (None, 1.0), ("one", 0.7)]
    rows = [(None if lang is None else str(lang), s, int(lang not in (None, "xx") and rng.random() < s)) for lang, s in rows]
    found = {r["lang"]: r for r in toxicity.best_cuts(spark.createDataFrame(rows, "lang string, score double, y int")).collect()}
    assert set(found) == {None, "en", "de", "xx", "one"}
    for lang, row in found.items():
        mine = [r for r in rows if lang is None or r[0] == lang]
        assert row["found"] == sum(r[2] for r in mine)
        if row["found"]:
            # Rows of one score are on the same side of a cut.
            levels = sorted({r[1] for r in mine}, reverse=True)
            f1 = [2 * sum(y for _, s, y in mine if s >= c) / (sum(s >= c for _, s, _ in mine) + row["found"]) for c in levels]
            k = int(np.argmax(f1))
            assert row["cut"] == pytest.approx((levels[k] + [*levels, 0.0][k + 1]) / 2)
    apart = [("en", s / 1000, int(s > 400)) for s in rng.permutation(1000)[:300].tolist()]
    cut = toxicity.best_cuts(spark.createDataFrame(apart, "lang string, score double, y int")).first()["cut"]
    assert cut == pytest.approx(toxicity.best_threshold(np.array([r[1] for r in apart]), np.array([r[2] for r in apart]), weight=0))


def test_toxicity_learns_from_every_labelled_row(spark):
    rng = random.Random(8)
    words, vile = [f"word{k}" for k in range(200)], [f"vile{k}x" for k in range(40)]
    docs, labels = [], []
    for k in range(4000):
        body = rng.choices(words, k=rng.randint(5, 40))
        if k % 4 == 0:
            body.insert(rng.randrange(len(body)), rng.choice(vile))
        docs.append((k, " ".join(body), rng.choice(["en", "de"])))
        labels.append((k, int(k % 4 == 0)))
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    found = toxicity.toxicity(docs, labels, most_rows=150).where("held_out").join(labels, "doc_id").collect()
    # 150 texts hold few of the forty words, and none of them four times.
    caught = np.mean([r["predicted"] for r in found if r["toxic"] == 1])
    spared = np.mean([1 - r["predicted"] for r in found if r["toxic"] == 0])
    assert caught > 0.8 and spared > 0.8, (caught, spared)
    # A sample without any toxic row.
    none = labels.withColumn("toxic", F.when(F.xxhash64("doc_id") < -(1 << 60), F.lit(0)).otherwise(F.col("toxic")))
    scores = toxicity.toxicity(docs, none, most_rows=150).where("held_out").join(none, "doc_id").where("toxic = 1 OR doc_id % 4 > 0").collect()
    mean = [np.mean([r["score"] for r in scores if r["toxic"] == y]) for y in (0, 1)]
    assert mean[1] > mean[0] + 0.1, mean


def test_gradients_match_differences():
    pages = htmltext.layouts(3, seed=1)
    model = htmltext.Labeller.fresh(3, np.random.default_rng(0))
    x, mask, back = htmltext._padded([p for p, _ in pages])
    wanted = np.zeros(mask.shape, np.float32)
    for k, (_, labels) in enumerate(pages):
        wanted[: len(labels), k] = labels

    def loss():
        z = model._logits(x, back)[0].astype(np.float64)
        return (np.logaddexp(0, z) - wanted * z)[mask].mean()

    found = model.gradients(x, mask, back, wanted)
    for name in ("wf", "ub", "bf", "v", "a"):
        w = model.weights[name]
        at = np.unravel_index(int(np.abs(found[name]).argmax()), w.shape)
        keep, step = w[at], 1e-2
        w[at] = keep + step
        up = loss()
        w[at] = keep - step
        slope = (up - loss()) / (2 * step)
        w[at] = keep
        assert abs(slope - found[name][at]) < 0.05 * abs(slope) + 1e-4, name


def test_main_text_of_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r["page_id"]: r["text"] for r in htmltext.main_text(pages).collect()}
    wanted = {r["page_id"]: " ".join(b.text for b in htmltext.blocks_of(r["html"]) if any(p.split()[0] == "article" for p in b.path)) for r in pages.collect()}
    assert sum(found[k] == wanted[k] for k in wanted) >= 0.98 * len(wanted)


def test_blocks():
    page = """<html><head><title>T</title><style>p{}</style></head><body><script>if (a<b) "</p>"</script><nav class='Top menu'><a href="x">one</a></nav>
    <p>a&amp;b &eacute;<br>c <b>d</b><p>e<!-- x --><li>f<li>g <img alt=">"> h<textarea>i"""
    assert [(b.text, b.path[-1]) for b in htmltext.blocks_of(page)] == [("T", "title"), ("one", "nav top menu"), ("a&b é c d", "p"), ("e", "p"), ("f", "li"), ("g h", "li"), ("i", "textarea")]
    assert htmltext.blocks_of("") == [] and [b.text for b in htmltext.blocks_of("plain < text")] == ["plain < text"]
    assert [b.text for b in htmltext.blocks_of("<p>a<script>never closed <p>b")] == ["a"]


def test_unclosed_elements_hide_no_text():
    texts = lambda page: [b.text for b in htmltext.blocks_of(page)]
    for tag in sorted(htmltext.NO_TEXT - htmltext.RAW):
        assert texts(f"<article><p>First<p><{tag} src=a><p>Second</p><p>Third</article>") == ["First", "Second", "Third"]
        assert texts(f"<p>a<{tag}>hidden<p>too</{tag}>b<p>c") == ["ab", "c"]
        assert texts(f"<p>a<{tag} x=1>b<p>c<{tag}>hidden</{tag}><p>d") == ["ab", "c", "d"]
        assert texts(f"<p>a<{tag}><{tag}>hidden</{tag}>hidden</{tag}>b") == ["ab"]
    assert texts("<p>a<svg/>b<style>x<p>y") == ["ab"] and texts("<p>a<style>x</style >b</video>") == ["ab"]


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    found = toxicity.toxicity(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    joined = found.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet").where("toxic IS NOT NULL"), "doc_id").select("predicted", "toxic").collect()
    shares = [np.mean([r["predicted"] == r["toxic"] for r in joined if r["toxic"] == y]) for y in (0, 1)]
    assert len(joined) >= 30 and np.mean(shares) >= 0.9


def test_learners_take_a_bounded_sample(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"row {k} of one id", "en") for k in range(300)] + [(1, "same row", "en")] * 200 + [(k, f"text {k}", "en") for k in range(2, 60)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(1, 60)], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, y: seen.append(len(texts)) or toxicity.Network.fresh(np.random.default_rng(0), (1,), 4, 2))
    toxicity.learn(docs, labels, "doc_id", "text", "lang", most_rows=20)
    toxicity.learn(docs, labels, "doc_id", "text", "lang", most_bytes=50)
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append(len(x)) or fit(x, y))
    quality.learn(quality.feature_rows(docs).coalesce(3), labels, most_rows=20)
    assert 1 <= seen[0] <= 20 and 1 <= seen[1] <= 8 and 1 <= seen[2] <= 20


def plain_features(text):
    """The features of a text by their definitions, one at a time."""
    words = [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    if not words:
        return [0.0] * len(quality.FEATURES)
    n, letters = len(words), [c for c in text if c not in " \t\n\x0b\x0c\r"]
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    spaces = [x.count(" ") + 1 for x in lines]
    mean = sum(spaces) / len(spaces)
    windows = Counter(zip(words, words[1:], words[2:])) or {0: 1}
    share = lambda keep: sum(map(keep, letters)) / len(letters)
    of_words = lambda keep: sum(map(keep, words)) / n
    return [
        math.log1p(n), math.log1p(len(letters)), sum(map(len, words)) / n, len(set(words)) / n,
        of_words(lambda w: len(w) <= 3), of_words(lambda w: len(w) >= 10),
        share(lambda c: "A" <= c <= "Z"), share(lambda c: "0" <= c <= "9"), share(lambda c: c in "#*$%&<>{}[]\\^~_=+@"),
        text.count("|") / n, text.count("!") / n, text.count(".") / n, text.count(",") / n, share(lambda c: ord(c) > 127),
        math.log1p(len(lines)), math.log1p(mean), (sum((x - mean) ** 2 for x in spaces) / len(spaces)) ** 0.5 / mean,
        1 - len(set(lines)) / len(lines), sum(k for k in windows.values() if k > 1) / sum(windows.values()),
        of_words(lambda w: chr(w[0]).isascii() and chr(w[0]).isupper()), max(Counter(words).values()) / n,
        share(lambda c: c.isascii() and c.isalpha() or ord(c) > 127),
    ]


def test_features_match_their_definitions(spark):
    texts = ["", " \n\t", "one", "A b C!", "x | y | # $ 5%\n\n x | y\x0bz", "Größe über alles, größe über alles.\nnaïve 日本語 text", "a b c a b c a b c\na b c"]
    texts += [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").limit(150).collect()]
    for text in texts:
        assert list(quality.features(text)) == pytest.approx(plain_features(text), abs=1e-12), text[:80]


def test_scores_are_sums_of_looked_up_numbers():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, len(quality.FEATURES)))
    model = quality.fit(x, (x[:, 0] * x[:, 1] + x[:, 2] > 0).astype(float), cycles=20, pair_cycles=10)
    for row, score in zip(x[:50], model.scores(x[:50])):
        total = model.base
        for f, (edges, table) in enumerate(zip(model.edges, model.tables)):
            total += table[sum(e <= row[f] for e in edges)]
        for (f, g), table in zip(model.pairs, model.pair_tables):
            total += table[sum(e <= row[f] for e in model.coarse[f]), sum(e <= row[g] for e in model.coarse[g])]
        assert score == pytest.approx(1 / (1 + math.exp(-total)))
    assert model.pairs
