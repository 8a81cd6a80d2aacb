import math
import random
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import functions as F

from indicata.llm import linededup
from indicata.llm.components import components
from indicata.llm.linededup import SIGNS, _masks, _verified, candidates, dedup_lines, hashed_lines, line_groups, normal_lines, word_signs


def test_simhash_matches_plain_votes(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 400)) for _ in range(n)) for n in (5, 6, 7, 126, 127, 128, 255, 256, 700, 1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc"]: (r["n"], r["sim"]) for r in hashed_lines(normal_lines(docs, "doc_id", "text"), 5).collect()}
    for k, text in enumerate(texts):
        words = set(text.split())
        hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
        wanted = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert found[k][0] == len(text.split()) and found[k][1] % (1 << 64) == wanted


def test_votes_of_every_number_of_words(spark):
    rng = random.Random(11)
    texts = [" ".join(f"{rng.choice('abcdefgh')}{k}" for k in range(n)) for n in range(5, 140)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc"]: r["sim"] for r in hashed_lines(normal_lines(docs, "doc_id", "text"), 5).collect()}
    for k, text in enumerate(texts):
        hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in text.split()]
        assert found[k] % (1 << 64) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_lines_that_stand_alone_are_joined_once(spark, monkeypatch):
    """All lines meet the repeated ones in one join; the classes and the places that go are found among these alone."""
    texts = [f"word{k} stands here with number {k * k} alone\n{LINE}" if k < 4 else f"word{k} stands here with number {k * k} alone" for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    joined, rows = linededup.dealt_join, []

    def counted(left, *rest):
        rows.append(left.count())
        return joined(left, *rest)

    monkeypatch.setattr(linededup, "dealt_join", counted)
    found = {r["doc_id"]: r["n_removed"] for r in dedup_lines(docs).collect()}
    assert found == {k: int(0 < k < 4) for k in range(60)}
    assert sum(n >= 60 for n in rows) == 1 and len(rows) > 1


def test_texts_are_hashed_once_a_row(spark, capsys):
    docs = spark.createDataFrame([(1, "a b\nc d")], "doc_id long, text string")
    normal_lines(docs, "doc_id", "text").explain()
    plan = capsys.readouterr().out
    assert plan.index("posexplode") < plan.index("xxhash64")  # parents are printed first


def test_every_pair_within_the_bits_is_a_candidate(spark):
    rng = random.Random(2)
    centre = [rng.getrandbits(64) for _ in range(8)]
    sims = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for c in centre for _ in range(30)})
    lines = spark.createDataFrame([(k, s - (1 << 64) if s >> 63 else s, 9) for k, s in enumerate(sims)], "line_id long, sim long, n int")
    near = {(i, j) for j in range(len(sims)) for i in range(j) if (sims[i] ^ sims[j]).bit_count() <= 3}
    found = {tuple(r) for r in candidates(lines, 3, 2, 10, 64).collect()}
    assert near <= found and all((sims[i] ^ sims[j]).bit_count() <= 10 for i, j in found)
    few = {tuple(r) for r in candidates(lines, 3, 2, 10, 8).collect()}
    assert all((sims[i] ^ sims[j]).bit_count() <= 10 for i, j in few)
    assert near <= few


def _around(rng, centres, copies, flips):
    sims = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))) for c in (rng.getrandbits(64) for _ in range(centres)) for _ in range(copies)})
    return sims, [(k, s - (1 << 64) if s >> 63 else s, 9) for k, s in enumerate(sims)]


def test_crowded_keys_lose_no_pair_of_the_guarantee(spark):
    sims, rows = _around(random.Random(2), 8, 30, 3)
    near = {(i, j) for j in range(len(sims)) for i in range(j) if (sims[i] ^ sims[j]).bit_count() <= 3}
    found = {tuple(r) for r in candidates(spark.createDataFrame(rows, "line_id long, sim long, n int"), 3, 2, 10, 4).collect()}
    assert near <= found and all((sims[i] ^ sims[j]).bit_count() <= 10 for i, j in found)


def test_far_pairs_do_not_depend_on_the_size_of_a_key(spark):
    _, rows = _around(random.Random(5), 2, 60, 5)
    lines = spark.createDataFrame(rows, "line_id long, sim long, n int")
    wide, narrow = ({tuple(r) for r in candidates(lines, 3, 2, 10, c).collect()} for c in (1000, 4))
    assert wide == narrow


def test_groups_of_crowded_keys_match_all_pairs(spark):
    words = [f"w{k}" for k in range(400)]
    rng = random.Random(6)
    fixed = rng.choices(words, k=300)
    # Orders of the same words: equal fingerprints, many of them far from the first line in edits.
    texts = [" ".join(fixed[k:] + fixed[:k]) for k in range(0, 300, 15)]
    texts += [" ".join(w if j != 7 else f"x{k}" for j, w in enumerate(fixed)) for k in range(10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wide, narrow = ({tuple(r) for r in line_groups(docs, crowded=c)[1].select("line_id", "keep.doc").collect()} for c in (1000, 2))
    assert wide == narrow and len(wide) == len(texts)


def test_pairs_of_linked_lines_are_not_compared_again(spark, monkeypatch):
    """The words of a line travel to few pairs: of a group, those of every line with its first neighbour."""
    rng = random.Random(9)
    words = [f"w{k}" for k in range(400)]
    texts = []
    for _ in range(3):
        fixed = rng.choices(words, k=120)
        texts += [" ".join(w if j != 7 else f"x{k}" for j, w in enumerate(fixed)) for k in range(25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    verified, compared = linededup._verified, []

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(linededup, "_verified", counted)
    found = {tuple(r) for r in line_groups(docs)[1].select("line_id", "keep.doc").collect()}
    assert len(found) == len(texts) and {doc for _, doc in found} == {0, 25, 50}
    assert sum(compared) < 2 * len(texts)


def test_few_links_are_not_spread_over_files(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        roots = components(spark.range(1, 200).selectExpr("id AS a", "id - 1 AS b"), "a", "b")
        assert {(r["node"], r["root"]) for r in roots.collect()} == {(k, 0) for k in range(1, 200)}
        assert len(roots.inputFiles()) == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_masks_keep_blocks_whole():
    assert len(_masks(5, 2)) == 10 and all(m.bit_count() >= 25 for m in _masks(5, 2))


def test_edit_similarity(spark):
    texts = ["abcdefghij", "abcdefghxx", "abcdefgxxx", "a" * 500, "a" * 400, "a" * 399, "ab" * 300, "ac" * 300]
    words = spark.createDataFrame([(k, [ord(c) for c in t]) for k, t in enumerate(texts)], "line_id long, hashes array<long>").withColumn("signs", word_signs(F.col("hashes")))
    pairs = spark.createDataFrame([(0, 0), (0, 1), (0, 2), (3, 4), (3, 5), (6, 7)], "a long, b long")
    assert sorted(tuple(r) for r in _verified(pairs, words, 0.8).collect()) == [(0, 0), (0, 1), (3, 4)]


LINE = "the quick brown fox jumps over the lazy dog near the old river bank while seven small birds sing in a tall green tree behind the house and nobody listens to them today"


def test_word_signs_are_one_character_a_word(spark):
    hashed = lambda c: F.transform(F.split(c, " "), lambda w: F.xxhash64(w))
    rows = spark.createDataFrame([("a b a",), ("b a é c",)], "t string").select(word_signs(hashed("t")).alias("s")).collect()
    one, two = (r["s"] for r in rows)
    assert len(one) == 3 and len(two) == 4 and one[0] == one[2] == two[1] and one[1] == two[0] and len(set(two)) == 4


def test_pairs_that_agree_by_signs_alone_are_no_links(spark):
    rows = [(1, [1, 2, 3, 4, 5]), (2, [1, 2 + SIGNS, 3 + SIGNS, 4, 5]), (3, [1, 2, 3, 4, 6])]
    words = spark.createDataFrame(rows, "line_id long, hashes array<long>").withColumn("signs", word_signs(F.col("hashes")))
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    assert [tuple(r) for r in _verified(pairs, words, 0.8).collect()] == [(1, 3)]


def test_one_occurrence_stays(spark):
    near = LINE.replace("seven", "eight")
    docs = spark.createDataFrame(
        [(3, f"intro of three\n{LINE.upper()}!"), (1, f"head\n{LINE}\n{LINE}\ntail"), (2, f"{near}\nshort line"), (4, None), (5, "a b c d e\nf")], "doc_id long, text string"
    )
    found = {r["doc_id"]: tuple(r)[1:] for r in dedup_lines(docs).collect()}
    assert found[1] == (f"head\n{LINE}\ntail", 4, 1)
    assert found[3] == ("intro of three", 2, 1)
    assert found[4] == (None, 1, 0) and found[5] == ("a b c d e\nf", 2, 0)


def test_groups_match_plain_links(spark):
    rng = random.Random(4)
    base = [" ".join(rng.choices([f"v{k}" for k in range(300)], k=60)) for _ in range(15)]
    texts = []
    for line in base:
        texts += [line, line]
        for _ in range(3):
            words = line.split()
            words[rng.randrange(60)] = "changed"
            texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lines, groups = line_groups(docs)
    keep = {r["line_id"]: r["keep"]["doc"] for r in groups.collect()}
    of = {r["doc"]: keep.get(r["line_id"]) for r in lines.collect()}
    for k in range(15):
        assert of[5 * k] == of[5 * k + 1] == 5 * k
        assert all(of[5 * k + j] in (None, 5 * k) or of[5 * k + j] // 5 == k for j in range(5))
    found = sum(of[5 * k + j] == 5 * k for k in range(15) for j in (2, 3, 4))
    assert found >= 25


def test_short_lines_and_lines_without_spaces(spark):
    rng = random.Random(7)
    letters = [chr(0x4E00 + k) for k in range(3000)]
    chinese = "".join(rng.choices(letters, k=300))
    near = chinese[:150] + "X" + chinese[151:]
    thai = "".join(chr(0x0E01 + rng.randrange(40)) for _ in range(80))
    docs = spark.createDataFrame(
        [(1, f"Read more\n{chinese}\n\n{thai}\nonly one"), (2, f"READ MORE!\n{near}\n\nread less"), (3, f"{thai}。\n{chinese}\n---\nonly two")], "doc_id long, text string"
    )
    found = {r["doc_id"]: tuple(r)[1:] for r in dedup_lines(docs).collect()}
    assert found[1] == (f"Read more\n{chinese}\n\n{thai}\nonly one", 5, 0)
    assert found[2] == ("\nread less", 4, 2)
    assert found[3] == ("---\nonly two", 4, 2)


def edits(a, b, most):
    """Levenshtein distance of two word lists, or more than ``most``."""
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        if min(now) > most:
            return most + 1
        before = now
    return before[-1]


def similar_pairs(lines, least):
    """All pairs of ``(line_id, words)`` with at least that similarity: lines so alike share one of their rarest words."""
    held = Counter(w for _, words in lines for w in set(words))
    index, out = defaultdict(list), []
    for line_id, words in sorted(lines, key=lambda r: len(r[1])):
        rare = sorted(set(words), key=lambda w: (held[w], w))
        most = math.floor(len(words) * (1 - least) + 1e-9)
        for other, its in {(o, tuple(t)) for w in rare[: most + 1] for o, t in index[w]}:
            n = edits(words, list(its), most)
            if n <= most:
                out.append((1 - n / len(words), line_id, other))
        for w in rare[: math.floor(len(words) / least * (1 - least) + 1e-9) + 1]:
            index[w].append((line_id, words))
    return out


def test_recall_against_all_pairs_of_lines(spark):
    """On all lines of a table: nine of ten pairs of similarity 0.98 are in one group, and half of those from 0.8 on (measured 0.49)."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = hashed_lines(normal_lines(docs, "doc_id", "text"), 5).where("norm IS NOT NULL").select("line_id", "norm").distinct().collect()
    pairs = similar_pairs([(r["line_id"], r["norm"].split(" ")) for r in rows], 0.8)
    group = {r["line_id"]: r["keep"] for r in line_groups(docs)[1].collect()}
    recall = {}
    for least in (0.98, 0.95, 0.8):
        found = [a in group and group[a] == group.get(b) for s, a, b in pairs if s >= least]
        recall[least] = sum(found) / len(found)
    assert len(pairs) > 300 and recall[0.98] >= 0.9 and recall[0.95] >= 0.6 and recall[0.8] >= 0.45
