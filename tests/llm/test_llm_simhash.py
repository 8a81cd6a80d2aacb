import random

import numpy as np
import xxhash

from indicata.llm.components import components
from indicata.llm.simhash import fingerprint, group_bits, links, simhash_groups, thresholds, _with_counts, signed


def plain(text):
    words = [w for w in text.encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_match_plain_ones(monkeypatch):
    rng = random.Random(3)
    texts = ["", "  ", "One", "one TWO", "É é a", *(" ".join(rng.choice("ab cd ef gh".split()) for _ in range(n)) for n in (3, 4, 50, 400))]
    assert [fingerprint(t) for t in texts] == [plain(t) for t in texts]
    monkeypatch.setattr("indicata.llm.simhash.BLOCK", 7)
    assert [fingerprint(t) for t in texts] == [plain(t) for t in texts]


def roots(values, max_bits):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    ordered = sorted(values)
    for k, a in enumerate(ordered):
        for b in ordered[:k]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= max_bits:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {v: find(v) for v in values}


def clustered(rng, clusters, size, flips):
    out = {0}
    for _ in range(clusters):
        centre = rng.getrandbits(64)
        out |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, flips))) for _ in range(size)}
    return {signed(v) for v in out}


def check(spark, values, max_bits, crowded):
    fps = spark.createDataFrame([(v,) for v in values], "fp long").repartition(3)
    found = {r["node"]: r["root"] for r in components(links(fps, max_bits, crowded), "a", "b").collect()}
    assert {v: found.get(v, v) for v in values} == roots(values, max_bits)


def test_components_match_all_pairs(spark):
    check(spark, clustered(random.Random(1), 12, 25, 3), 2, 256)


def test_crowded_keys_lose_no_link(spark):
    check(spark, clustered(random.Random(2), 4, 80, 3), 2, 5)
    check(spark, clustered(random.Random(4), 3, 30, 3), 3, 5)


def test_thresholds_add_up_and_are_cheapest(spark):
    values = clustered(random.Random(5), 10, 10, 6)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    at = np.array([v % (1 << 64) for v in values], dtype=np.uint64)
    joint = np.zeros((64, 64))
    layout = group_bits(joint, len(values), 3)
    assert sorted(b for g in layout for b in g) == list(range(64))
    groups = _with_counts(fps, [layout], len(values), 2)[0]
    plan, cost = thresholds(groups, at, 2)
    assert (plan.sum(axis=1) == 0).all() and plan.min() >= -1
    near = groups.estimates(at, 2)
    assert (cost <= 3 + near[0][0] + near[1][0] + near[2][0] + 1e-9).all()


def test_copies_share_the_smallest_id(spark):
    text = " ".join(f"w{k}" for k in range(200))
    docs = spark.createDataFrame([(9, text), (4, text.upper()), (7, text + " tail"), (5, "else"), (None, text)], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in simhash_groups(docs).collect()}
    assert found[9] == found[4] == found[None] == 4 and found[5] == 5


def test_components_with_hubs_match_plain_sets(spark):
    rng = random.Random(9)
    pairs = [(0, k) for k in range(1, 4000)] + [(k, k + 1) for k in range(5000, 5060)] + [(rng.randrange(9000, 9400), rng.randrange(9000, 9400)) for _ in range(300)] + [(7, 7), (1, 0)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
