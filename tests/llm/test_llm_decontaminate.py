import random

import numpy as np

from indicata.llm.decontaminate import covered_share, decontaminate, run_hashes, tile, tokens


def greedy(doc, item, shortest):
    """The same tiling by looking at every pair of places."""
    free_d, free_i = [d >= 0 for d in doc], [i >= 0 for i in item]
    while True:
        best = 0
        for p in range(len(item)):
            for q in range(len(doc)):
                n = 0
                while p + n < len(item) and q + n < len(doc) and free_i[p + n] and free_d[q + n] and item[p + n] == doc[q + n]:
                    n += 1
                best = max(best, n)
        if best < shortest:
            return [i >= 0 and not f for i, f in zip(item, free_i)]
        for p in range(len(item) - best + 1):
            for q in range(len(doc) - best + 1):
                if all(free_i[p : p + best]) and all(free_d[q : q + best]) and list(item[p : p + best]) == list(doc[q : q + best]):
                    free_i[p : p + best] = [False] * best
                    free_d[q : q + best] = [False] * best


def test_tiles_match_plain_tiling():
    rng = random.Random(1)
    for _ in range(60):
        item = np.array([rng.randint(0, 4) for _ in range(rng.randint(1, 25))])
        doc = np.array([rng.randint(-1, 4) for _ in range(rng.randint(1, 40))])
        assert tile(doc, item, 3).tolist() == greedy(doc, item, 3)


def test_run_hashes_tell_runs_apart():
    ids = np.array([1, 2, 3, 1, 2, 3, 1])
    hashes = run_hashes(ids, 3)
    assert len(hashes) == 5 and hashes[0] == hashes[3] and len(set(hashes.tolist())) == 3
    assert len(run_hashes(ids, 8)) == 0


def docs_and_items(spark):
    rng = random.Random(7)
    words = [f"w{k}" for k in range(500)]
    items = [(k, " ".join(rng.choices(words, k=40))) for k in range(6)]
    filler = lambda n: " ".join(rng.choices(words, k=n))
    first, second = items[0][1].split(), items[1][1].split()
    docs = [
        (1, f"{filler(30)} {items[0][1].upper()}! {filler(30)}"),
        (2, f"{' '.join(second[20:])} {filler(9)} {' '.join(second[:20])}"),
        (3, f"{filler(20)} {' '.join(first[:8])} {filler(20)}"),
        (4, filler(100)),
        (5, f"{items[2][1]} {items[3][1]}"),
    ]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_copies_and_reordered_copies_are_found(spark):
    docs, items = docs_and_items(spark)
    found = {r["doc_id"]: r for r in decontaminate(docs, items).collect()}
    assert {k: r["item_ids"] for k, r in found.items()} == {1: [0], 2: [1], 3: [], 4: [], 5: [2, 3]}
    assert found[2]["coverage"] == 1.0 and 0.15 < found[3]["coverage"] < 0.5 and found[4]["best_item"] is None


def test_sent_and_shuffled_tables_give_the_same(spark):
    docs, items = docs_and_items(spark)
    read = lambda df: sorted(map(str, df.collect()))
    assert read(decontaminate(docs, items, sent=-1)) == read(decontaminate(docs.repartition(5), items.repartition(3)))


def test_documents_match_plain_coverages(spark):
    """Every pair by tiling of all words, repeated rows and items, nulls, short items and an empty benchmark."""
    rng = random.Random(11)
    words = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rng.choices(words, k=rng.randint(1, 25)))) for k in range(12)] + [(3, "w1 w2 w3 w4 w5 w6"), (3, "w1 w2 w3 w4 w5 w6"), (None, "w1 w2"), (50, None), (51, "..."), (52, "w7 w8")]
    docs = []
    for k in range(40):
        some = items[rng.randrange(12)][1].split()
        cut = rng.randint(0, len(some))
        docs.append((k % 30, " ".join(rng.choices(words, k=rng.randint(0, 30)) + some[cut:] + rng.choices(words, k=3) + some[:cut])))
    docs += [(None, docs[0][1]), (None, None), (99, ""), docs[1], docs[1]]
    found = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    wanted = []
    for d, t in docs:
        shares = [(covered_share(tokens(t or ""), tokens(x or ""), 5), i) for i, x in items if i is not None]
        best = max(((c, -i) for c, i in shares if c > 0), default=(0.0, None))
        wanted.append((d, sorted({i for c, i in shares if c >= 0.5}), None if best[1] is None else -best[1], round(best[0], 9)))
    got = [(r["doc_id"], r["item_ids"], r["best_item"], round(r["coverage"], 9)) for r in found.collect()]
    assert sorted(map(str, got)) == sorted(map(str, wanted))
    empty = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string"))
    assert empty.where("contaminated").count() == 0 and empty.count() == len(docs)


def test_short_items_must_occur_whole():
    assert covered_share(tokens("here are only three words again"), tokens("only three words"), 5) == 1.0
    assert covered_share(tokens("only three"), tokens("only three words"), 5) == 0.0
