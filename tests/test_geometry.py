import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from indicata.operators import geometry as geo

SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]


def shapes(spark, *given):
    """Frame of geometries given as polygons -> rings -> (x, y)."""
    return spark.createDataFrame([(i, g) for i, g in enumerate(given)], f"id int, geometry {geo.GEOMETRY.simpleString()}")


def simplified(spark, tolerance, *given):
    found = geo.simplify(shapes(spark, *given), "geometry", tolerance).select("id", F.col("geometry").alias("g")).orderBy("id").collect()
    return [None if r["g"] is None else [[[tuple(p) for p in ring] for ring in polygon] for polygon in r["g"]] for r in found]


def test_lines_rings_and_null(spark):
    two = [(0.0, 0.0), (1.0, 1.0)]
    straight = [(float(i), 0.0) for i in range(6)]
    ring = [(0.0, 0.0), (2.0, 0.0001), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    found = simplified(spark, 0.01, [[two]], [[straight]], [[ring]], None, [])
    assert found == [[[two]], [[[straight[0], straight[-1]]]], [[SQUARE]], None, []]


def test_small_ring_keeps_four_points(spark):
    tiny = [(math.cos(a) * 0.001, math.sin(a) * 0.001) for a in np.linspace(0, 2 * math.pi, 30)]
    tiny[-1] = tiny[0]
    (found,) = simplified(spark, 1.0, [[tiny]])
    ring = found[0][0]
    assert ring[0] == ring[-1] and len(ring) >= 4 and set(ring) <= set(tiny)


def test_parts_and_holes_survive(spark):
    hole = [(1.0, 1.0), (1.0, 2.0), (1.5, 2.00001), (2.0, 2.0), (2.0, 1.0), (1.0, 1.0)]
    island = [(9.0, 9.0), (9.5, 9.00001), (10.0, 9.0), (10.0, 10.0), (9.0, 9.0)]
    (found,) = simplified(spark, 0.01, [[SQUARE, hole], [island]])
    assert found == [[SQUARE, [p for p in hole if p != (1.5, 2.00001)]], [[p for p in island if p != (9.5, 9.00001)]]]


def test_shortcut_through_a_neighbour_is_not_taken(spark):
    """A bump around an island is within tolerance, but cutting it off would cut the island."""
    shell = [(0.0, 0.0), (4.0, 0.0), (5.0, 0.3), (6.0, 0.0), (10.0, 0.0), (10.0, -8.0), (0.0, -8.0), (0.0, 0.0)]
    island = [(4.9, -0.1), (5.1, -0.1), (5.1, 0.2), (4.9, 0.2), (4.9, -0.1)]
    (alone,) = simplified(spark, 0.5, [[shell]])
    assert (5.0, 0.3) not in alone[0][0]
    (found,) = simplified(spark, 0.5, [[shell, island]])
    assert (5.0, 0.3) in found[0][0]


def wiggly(rng, n=200):
    angle = np.linspace(0, 2 * math.pi, n + 1)
    radius = 1 + 0.3 * rng.normal(size=n + 1).cumsum() / math.sqrt(n)
    radius = np.maximum(radius, 0.2)
    ring = [(float(r * math.cos(a)), float(r * math.sin(a))) for r, a in zip(radius, angle)]
    ring[-1] = ring[0]
    return ring


def crossings(ring):
    p = np.array(ring)
    x, y = p[:, 0], p[:, 1]
    a = np.arange(len(p) - 1)
    return geo._any_meeting(x, y, a, a + 1, a, a + 1)


def test_removed_vertices_lie_within_tolerance_and_nothing_crosses(spark):
    rng = np.random.default_rng(7)
    given = [wiggly(rng) for _ in range(40)]
    found = simplified(spark, 0.05, *[[[r]] for r in given])
    for before, ((after,),) in zip(given, found):
        assert after[0] == before[0] and after[-1] == before[-1]
        kept = [before.index(p) for p in after[:-1]] + [len(before) - 1]
        assert kept == sorted(kept) and len(after) < len(before)
        x, y = np.array(before).T
        for i, j in zip(kept[:-1], kept[1:]):
            if j - i > 1:
                assert geo._segment_distance(x, y, i, j, np.arange(i + 1, j)).max() <= 0.05
        assert crossings(after) <= crossings(before)


def doubtful(x, y, keep, bounds):
    """The same question as the grid join's, by all pairs: a ring came out small, or a shortcut meets a piece."""
    ring_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for begin, end in zip(bounds[:-1], bounds[1:]):
        if end - begin > geo.RING_POINTS and keep[begin:end].sum() <= geo.RING_POINTS and x[begin] == x[end - 1] and y[begin] == y[end - 1]:
            return True
    before, after = np.arange(len(x)), np.flatnonzero(keep)
    (a, b), (i, j) = ((s[:-1][ring_of[s[:-1]] == ring_of[s[1:]]], s[1:][ring_of[s[:-1]] == ring_of[s[1:]]]) for s in (before, after))
    a, b = np.concatenate([a, i]), np.concatenate([b, j])
    cuts = j - i > 1
    return any(geo._any_meeting(x, y, i[cuts][k : k + 1], j[cuts][k : k + 1], a, b) for k in range(cuts.sum()))


def walk(rng, n):
    steps = rng.integers(-9, 10, (n, 2)).cumsum(axis=0).astype(float)
    return [tuple(map(float, p)) for p in steps]


def test_grid_join_finds_what_all_pairs_find(spark):
    rng = np.random.default_rng(12)
    given = [[[walk(rng, int(n))] for _ in range(rng.integers(1, 3))] for n in rng.integers(3, 200, 60)] + [[[wiggly(rng)]] for _ in range(20)]
    given.append([[[(0.0, 0.0), (1e9, 0.5), (2e9, 0.0), (2e9, 1e9), (1.5e9, 0.2), (3.0, 5.0), (3.0, 4.0)]]])
    for tolerance in (4.0, 30.0):
        drawn = geo.drawn_outlines(shapes(spark, *given), "geometry", tolerance)
        met = {r["id"] for r in geo.conflicts(drawn).join(drawn.select("_row", "id"), "_row").select("id").collect()}
        small = {r["id"] for r in drawn.where("_drawn.small").select("id").collect()}
        wanted, shaped = set(), simplified(spark, tolerance, *given)
        for k, polygons in enumerate(given):
            rings = [np.array(r) for p in polygons for r in p]
            x, y = np.concatenate(rings).T
            ends = np.concatenate([[0], np.cumsum([len(r) for r in rings])])
            keep = geo._halved(x, y, ends, tolerance)
            if not keep.all() and doubtful(x, y, keep, ends):
                wanted.add(k)
                keep = geo._kept(x, y, ends, tolerance)
            flat = [p for polygon in shaped[k] for ring in polygon for p in ring]
            assert flat == [tuple(p) for p, kept in zip(np.column_stack([x, y]).tolist(), keep) if kept]
        assert met | small == wanted and len(wanted) > 10


def test_pieces_are_found_near_and_far():
    rng = np.random.default_rng(13)
    for n in (5, 60, 400):
        x, y = np.array(walk(rng, n)).T
        pieces = geo._Pieces(x, y, np.arange(n - 1))
        alive = np.ones(n, dtype=bool)
        for _ in range(60):
            i, j = sorted(rng.choice(np.flatnonzero(alive), 2, replace=False).tolist())
            index = np.flatnonzero(alive)
            wanted = geo._any_meeting(x, y, np.array([i]), np.array([j]), index[:-1], index[1:])
            assert pieces.meet(i, j) == wanted
            if j - i > 1 and all(alive[i:j]) and rng.random() < 0.5:
                pieces.replace(i, j)
                alive[i + 1 : j] = False


def test_batch_and_stepwise_simplification_agree():
    rng = np.random.default_rng(9)
    for tolerance in (0.02, 0.2, 1.0, 3.0):
        rings = [np.array(wiggly(rng, int(n))) for n in rng.integers(3, 120, 30)]
        x, y = np.concatenate(rings).T
        ends = np.concatenate([[0], np.cumsum([len(r) for r in rings])])
        fast = geo._halved(x, y, ends, tolerance)
        for a, b in zip(ends[:-1], ends[1:]):
            bounds = np.array([0, b - a])
            slow = geo._kept(x[a:b], y[a:b], bounds, tolerance)
            quick = fast[a:b]
            if quick.all() or not doubtful(x[a:b], y[a:b], quick, bounds):
                assert (quick == slow).all()


def test_well_known_binary_round_trip(spark):
    one = [[SQUARE]]
    several = [[SQUARE, [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (1.0, 1.0)]], [[(9.0, 9.0), (9.0, 10.0), (10.0, 9.0), (9.0, 9.0)]]]
    df = shapes(spark, one, several, None)
    back = df.select("id", geo.from_wkb(geo.to_wkb("geometry")).alias("geometry"))
    assert rows(back) == rows(df)
    # A unit triangle as other tools write it, big-endian.
    text = "00" + "00000003" + "00000001" + "00000004"
    text += "".join(np.array(p, dtype=">f8").tobytes().hex() for p in ((0, 0), (1, 0), (0, 1), (0, 0)))
    given = spark.createDataFrame([(bytearray.fromhex(text),)], "w binary")
    ((polygon,),) = given.select(geo.from_wkb("w")).first()[0]
    assert [tuple(p) for p in polygon] == [(0, 0), (1, 0), (0, 1), (0, 0)]


def test_other_geometry_types_are_refused(spark):
    point = bytearray.fromhex("0101000000" + "00" * 16)
    with pytest.raises(Exception, match="neither polygon"):
        spark.createDataFrame([(point,)], "w binary").select(geo.from_wkb("w")).collect()


def test_geometry_join_keeps_every_gold_row(spark):
    gold = spark.createDataFrame([("1", 5.0), ("2", 6.0)], "code string, gdp double")
    polygons = shapes(spark, None, [[SQUARE]]).select(F.col("id").alias("code"), F.lit("SP").alias("UF"), "geometry")
    found = geo.join_geometry(gold, polygons, "code").select("code", "UF", geo.point_count(F.col("geometry")))
    assert found.schema["code"].dataType.simpleString() == "bigint"
    assert rows(found) == [(1, "SP", 5), (2, None, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        geo.join_geometry(gold.withColumn("code", F.lit("x1")), polygons, "code").collect()
