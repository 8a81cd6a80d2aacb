import random

import numpy as np
import pytest

from indicata.llm import vectorcodes
from indicata.llm.vectorcodes import nearest, vector_codes


def plain_nearest(parts, entries):
    out = []
    for part in parts:
        far = [(sum((int(a) - int(b)) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(entries)]
        out.append(min(far))
    return [k for _, k in out], [d for d, _ in out]


@pytest.mark.parametrize("big", [1, 1 << 30])
def test_search_finds_the_lower_of_the_nearest(big):
    rng = np.random.default_rng(3)
    entries = rng.integers(-6, 7, (90, 5)) * big
    entries[40] = entries[7]
    parts = np.concatenate([rng.integers(-9, 10, (700, 5)) * big, entries])
    at, far = nearest(parts.astype(np.float64), entries.astype(np.float64))
    wanted = plain_nearest(parts, entries)
    assert at.tolist() == wanted[0] and [int(v) for v in far] == wanted[1]


def test_plain_search_is_the_same():
    rng = np.random.default_rng(4)
    entries, parts = rng.integers(-50, 51, (64, 6)).astype(object), rng.integers(-60, 61, (200, 6)).astype(object)
    assert [x.tolist() for x in nearest(parts, entries)] == [x.tolist() for x in nearest(parts.astype(float), entries.astype(float))]


def plain_codes(rows, parts=4, size=256, rounds=4):
    """rows: (id, label, vector); codes, errors and entries by loops over integers."""
    rows = [(i, g, [int(np.floor(1024 * float(x))) if abs(x) < 1e9 else int(x) * 1024 for x in v]) for i, g, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    dim = len(ordered[0][2])
    edges = [dim * k // parts for k in range(parts + 1)]
    books = [[r[2][a:b] for r in ordered[:size]] for a, b in zip(edges, edges[1:])]
    for step in range(rounds + 1):
        at = [plain_nearest([r[2][a:b] for r in rows], book) for (a, b), book in zip(zip(edges, edges[1:]), books)]
        if step < rounds:
            for p, (a, b) in enumerate(zip(edges, edges[1:])):
                for k in range(len(books[p])):
                    own = [r[2][a:b] for r, e in zip(rows, at[p][0]) if e == k]
                    if own:
                        books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    codes = ["".join(f"{at[p][0][i]:02x}" for p in range(parts)) for i in range(len(rows))]
    errors = [sum(at[p][1][i] for p in range(parts)) for i in range(len(rows))]
    label = {g: sum(e for (_, h, _), e in zip(rows, errors) if h == g) for _, g, _ in rows}
    return sorted((i if i is not None else -1, c, e, label[g]) for (i, g, _), c, e in zip(rows, codes, errors)), books


@pytest.mark.parametrize("dim, size", [(8, 12), (10, 256)])
def test_codes_match_plain_loops(spark, dim, size):
    rng = random.Random(dim)
    rows = [(k * 3 % 101, rng.choice([None, 1, 2]), [rng.gauss(0, 1) for _ in range(dim)]) for k in range(90)]
    rows += rows[:3] + [(500, 1, None), (501, 2, [0.0] * (dim - 1) + [None]), (502, 2, [float("nan")] * dim), (503, 1, [float("inf")] * dim), (None, None, [0.25] * dim)]
    made, books = vector_codes(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"), size=size)
    stored = [(i, g, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, g, v in rows]
    wanted, entries = plain_codes(stored, size=size)
    assert sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["code"], r["error"], r["label_error"]) for r in made.collect()) == wanted
    assert [[list(map(int, e)) for e in b.tolist()] for b in books.books] == entries
    assert len(books.decode(wanted[0][1])) == dim


def test_numbers_of_any_size(spark):
    rows = [(k, 0, [1e30 * (k % 3), float(k), -1e25, 2.0**45]) for k in range(9)]
    made, books = vector_codes(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), parts=2, size=2)
    wanted, entries = plain_codes(rows, parts=2, size=2)
    assert [[list(map(int, e)) for e in b.tolist()] for b in books.books] == entries
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in made.collect()) == [(i, c, min(e, vectorcodes.LONGEST)) for i, c, e, _ in wanted]


def test_empty_odd_lengths_and_clashing_names(spark):
    schema = "vec_id long, label int, embedding array<float>, code string, own int"
    made, books = vector_codes(spark.createDataFrame([], schema))
    assert made.count() == 0 and books.sha256() == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    made, _ = vector_codes(spark.createDataFrame([(1, 1, [0.5] * 4, "x", 7), (2, 1, [0.5] * 3, "y", 8), (3, 1, [0.5] * 4, "z", 9)], schema))
    found = {r["vec_id"]: r for r in made.collect()}
    assert found[1]["code"] == "00000000" == found[3]["code"] and found[2]["code"] is None and found[2]["error"] is None
    assert found[2]["own"] == 8 and found[1]["label_error"] == 0 and made.columns == ["vec_id", "label", "embedding", "own", "code", "error", "label_error"]
