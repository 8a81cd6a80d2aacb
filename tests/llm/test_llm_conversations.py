import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from indicata.llm.conversations import Trees, _middles, ordered_turns, prefix_trie
from indicata.llm.queries.conversations import rebuilt

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_turns(rows):
    """conv: list of (role, text), in order."""
    out = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            out[c].append((t is not None, t or 0, r or "", x or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in out.items()}


def plain_rebuilt(turns):
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    return out


def plain_trie(turns):
    members = defaultdict(list)
    for c, said in turns.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    out = []
    total = {}
    for path in sorted(members, key=len, reverse=True):
        size = len(path[-1][1].encode()) if path else 0
        own = (len(members[path]) - 1) * size
        below = [total[k] for k in kids[path]]
        total[path] = (own + sum(s for s, _ in below), sum(n for _, n in below) or 1)
        ends = ",".join(str(c) for c in sorted(c for c in members[path] if len(turns[c]) == len(path)))
        out.append((min(members[path]), len(path), min(members[path[:-1]]) if path else None, len(members[path]), len(kids[path]), total[path][1], total[path][0], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def random_rows(seed, conversations=60, longest=14):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-20, 200), conversations):
        said = [(None, "user", rng.choice("ab"))] if rng.random() < 0.2 else []
        for t in range(rng.randint(0 if said else 1, longest)):
            said.append((t * 2, rng.choice(["user", "user", None]), rng.choice(["é", "b", None, "long text", "é"])))
        rows += [(c, *s) for s in said]
    rows += [(None, 1, "user", "no one's")] + [(1000 + k, t, "user", "same") for k in range(40) for t in range(5)]
    rng.shuffle(rows)
    return rows


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("band, chunk, seed", [(512, 200_000, 1), (4, 25, 2), (1, 3, 3), (5, 60, 4)])
def test_trie_matches_plain_prefixes(spark, band, chunk, seed):
    rows = random_rows(seed)
    turns, lengths = rebuilt(ordered_turns(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    wanted = plain_trie(plain_rebuilt(plain_turns(rows)))
    assert found(prefix_trie(turns, lengths, band, chunk)) == wanted


def test_places_count_on_over_tasks(spark):
    rows = [(1, k // 3, "user", f"t{k % 7}") for k in range(900)] + [(c, 0, None, "x") for c in (0, 2, 3)]
    turns = ordered_turns(spark.createDataFrame(rows, SCHEMA).repartition(7))
    got = {(r["conv"], r["pos"]) for r in turns.collect()}
    assert got == {(1, k) for k in range(900)} | {(c, 0) for c in (0, 2, 3)}
    assert turns.groupBy("conv").agg(F.count("pos").alias("n")).count() == 4


def test_long_conversations_of_one_band_after_the_other(spark):
    same = [(c, t, "user", f"turn {t % 50}") for c in (1, 2, 3) for t in range(200 + c)]
    turns = ordered_turns(spark.createDataFrame(same, SCHEMA))
    lengths = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("total"))
    assert found(prefix_trie(turns, lengths, 16, 40)) == plain_trie(plain_turns(same))


def test_end_lists_longer_than_a_row(spark):
    rows = [(k, 0, "user", "hello") for k in range(3500)] + [(5000 + k, 0, "user", "bye") for k in range(1200)]
    turns = ordered_turns(spark.createDataFrame(rows, SCHEMA))
    lengths = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("total"))
    assert found(prefix_trie(turns, lengths)) == plain_trie(plain_turns(rows))


def test_no_conversation_and_clashing_columns(spark):
    empty = ordered_turns(spark.createDataFrame([], SCHEMA))
    assert prefix_trie(*rebuilt(empty)).count() == 0
    rows = spark.createDataFrame([(7, 1, "user", "x" * 100_000, 3, "k")], SCHEMA + ", pos int, k1 string")
    assert [r["n_convs"] for r in prefix_trie(*rebuilt(ordered_turns(rows))).orderBy("depth").collect()][0] == 1


def test_middle_first_keeps_trees_flat():
    trees = Trees()
    rows = [{"ids": [k], "sizes": [1], "P1": 0, "P2": 0, "U1": k, "U2": 0, "n": 1, "first": k, "goes_on": False} for k in range(1023)]
    for k in _middles(1023):
        trees.insert(rows[k], 0, False)
    deepest = 0
    for k in range(1023):
        steps, at = 0, trees.equal[0]
        while trees.turn[at] != k:
            steps, at = steps + 1, (trees.lower if k < trees.turn[at] else trees.higher)[at]
        deepest = max(deepest, steps)
    assert deepest == 9 and sorted(_middles(10)) == list(range(10))
