"""Territory polygons: well-known binary, topology-keeping simplification, outline measures.

A geometry is ``array<array<array<struct<x, y>>>>`` - polygons, their rings, their
points. The functions here are Arrow column functions, one geometry per row, so
Spark spreads them like any projection; inside a batch they work on flat arrays.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.storage import staged

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
GEOMETRY = T.ArrayType(T.ArrayType(T.ArrayType(POINT)))
_ARROW_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])

# Geometry type codes of well-known binary.
WKB_POLYGON = 3
WKB_MULTIPOLYGON = 6
# Points a closed ring, or an open line, keeps at the least.
RING_POINTS = 4
LINE_POINTS = 2
# Cells that a piece may cover before it is kept in a list of its own, and that a search may look into.
CELLS_OF_PIECE, CELLS_OF_SEARCH = 16, 1024


# --- simplification ---------------------------------------------------------

PIECE = T.StructType(
    [T.StructField(c, T.IntegerType()) for c in ("a", "b")]
    + [T.StructField(c, T.DoubleType()) for c in ("ax", "ay", "bx", "by")]
    + [T.StructField("level", T.IntegerType())]
)
DRAWN = T.StructType([T.StructField("keep", T.ArrayType(T.BooleanType())), T.StructField("small", T.BooleanType()), T.StructField("pieces", T.ArrayType(PIECE)), T.StructField("top", T.IntegerType())])


def simplify(df: DataFrame, geometry: str, tolerance: float) -> DataFrame:
    """``df`` with the vertices of a geometry dropped that lie within ``tolerance`` of the outline that remains.

    Ends of lines and start points of rings stay; a closed ring keeps at least four points; a shortcut that would
    cross or touch another piece of the same geometry is not taken. Null stays null.

    All outlines are first halved as if no shortcut met anything. A join over the cells of a grid then finds the
    shortcuts that do, whatever task the outline's pieces are in; only those outlines are done again, one shortcut
    after the other, each tested against the pieces in its neighbourhood.
    """
    drawn = drawn_outlines(df, geometry, tolerance)
    doubtful = conflicts(drawn).select("_row").union(drawn.where("_drawn.small").select("_row")).distinct().withColumn("_again", F.lit(True))
    doubtful = staged(doubtful, "outlines")
    told = drawn.withColumn("_again", F.lit(False)) if doubtful.isEmpty() else drawn.join(doubtful, "_row", "left")

    @F.arrow_udf(GEOMETRY)
    def finish(column: pa.Array, keep: pa.Array, again: pa.Array) -> pa.Array:
        return _finished(column, keep, again, tolerance)

    shape = finish(F.col(f"`{geometry}`"), F.col("_drawn.keep"), F.coalesce("_again", F.lit(False)))
    return told.select(*((shape if c == geometry else F.col(f"`{c}`")).alias(c) for c in df.columns))


def drawn_outlines(df: DataFrame, geometry: str, tolerance: float) -> DataFrame:
    """``df`` stored with ``_row`` and ``_drawn``: the vertices that halving keeps, whether a ring came out small, and the
    pieces of the outline before and after (vertices ``a, b``, ends, and the level of the grid that fits them)."""

    @F.arrow_udf(DRAWN)
    def draw(column: pa.Array) -> pa.Array:
        return _drawn_batch(column, tolerance)

    return staged(df.withColumns({"_drawn": draw(F.col(f"`{geometry}`")), "_row": F.monotonically_increasing_id()}), "drawn")


def conflicts(drawn: DataFrame) -> DataFrame:
    """``_row, i, j, a, b``: shortcuts i-j that meet a piece a-b of the same outline that lies outside i..j.

    A grid has cells of 2^level; a piece no longer than that touches four of them at the most. Two pieces are
    compared at the level of the longer one, in every cell they share.
    """
    pieces = drawn.select("_row", "_drawn.top", F.explode("_drawn.pieces").alias("p")).select("_row", "top", "p.*")

    def placed(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("at", F.explode(F.sequence("level", "top")))
        cell = F.pow(F.lit(2.0), F.col("at"))
        for axis in ("x", "y"):
            ends = [F.floor(F.least(f"a{axis}", f"b{axis}") / cell), F.floor(F.greatest(f"a{axis}", f"b{axis}") / cell)]
            rows = rows.withColumn(f"c{axis}", F.explode(F.sequence(*ends)))
        return rows.drop("top")

    names = {"a": "i", "b": "j", "ax": "ix", "ay": "iy", "bx": "jx", "by": "jy", "level": "l"}
    cuts = placed(pieces.where("b - a > 1")).withColumnsRenamed(names)
    near = cuts.join(placed(pieces), ["_row", "at", "cx", "cy"])
    near = near.where((F.greatest("l", "level") == F.col("at")) & ((F.col("b") <= F.col("i")) | (F.col("a") >= F.col("j"))))
    for axis in ("x", "y"):
        near = near.where(F.greatest(f"a{axis}", f"b{axis}") >= F.least(f"i{axis}", f"j{axis}"))
        near = near.where(F.least(f"a{axis}", f"b{axis}") <= F.greatest(f"i{axis}", f"j{axis}"))
    return near.where(_meeting()).select("_row", "i", "j", "a", "b").distinct()


def _meeting() -> Column:
    """Segments i-j and a-b cross, or an end of one lies inside the other."""

    def side(p: str, q: str, r: str) -> Column:
        c = lambda name: F.col(name)
        return F.signum((c(q + "x") - c(p + "x")) * (c(r + "y") - c(p + "y")) - (c(q + "y") - c(p + "y")) * (c(r + "x") - c(p + "x")))

    def inside(p: str, q: str, r: str) -> Column:
        d = {axis: F.col(q + axis) - F.col(p + axis) for axis in "xy"}
        reach = (F.col(r + "x") - F.col(p + "x")) * d["x"] + (F.col(r + "y") - F.col(p + "y")) * d["y"]
        return (side(p, q, r) == 0) & (reach > 0) & (reach < d["x"] * d["x"] + d["y"] * d["y"])

    crossing = (side("i", "j", "a") * side("i", "j", "b") < 0) & (side("a", "b", "i") * side("a", "b", "j") < 0)
    return crossing | inside("i", "j", "a") | inside("i", "j", "b") | inside("a", "b", "i") | inside("a", "b", "j")


def _parts(column: pa.Array) -> tuple:
    """Coordinates of a batch of geometries, and where geometries, polygons and rings end."""
    polygons = _members(column)
    rings = _members(polygons)
    points = _members(rings)
    x, y = (points.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    ends = [np.concatenate([[0], np.cumsum(_lengths(a))]) for a in (column, polygons, rings)]
    return points, x, y, *ends


def _drawn_batch(column: pa.Array, tolerance: float) -> pa.Array:
    _, x, y, geometry_ends, polygon_ends, ring_ends = _parts(column)
    keep = _halved(x, y, ring_ends, tolerance)
    ring_of = np.repeat(np.arange(len(ring_ends) - 1), np.diff(ring_ends))
    after = np.flatnonzero(keep)
    sections = [np.arange(len(x) - 1), np.arange(1, len(x))], [after[:-1], after[1:]]
    (a, b), (i, j) = ([s[ring_of[p] == ring_of[q]] for s in (p, q)] for p, q in sections)
    cuts = j - i > 1
    a, b = np.concatenate([a, i[cuts]]), np.concatenate([b, j[cuts]])
    point_ends = ring_ends[polygon_ends[geometry_ends]]
    owner = np.searchsorted(point_ends, a, "right") - 1
    kept_all = np.array([keep[s:e].all() for s, e in zip(point_ends, point_ends[1:])], dtype=bool)
    open_ = ~kept_all[owner] if len(owner) else np.zeros(0, dtype=bool)
    order = np.argsort(owner[open_], kind="stable")
    a, b, owner = a[open_][order], b[open_][order], owner[open_][order]
    extent = np.maximum(np.abs(x[a] - x[b]), np.abs(y[a] - y[b]))
    level = np.ceil(np.log2(np.maximum(extent, 1e-300))).astype(np.int64)
    ends = np.searchsorted(owner, np.arange(len(column) + 1))
    top = np.zeros(len(column), dtype=np.int64)
    for g in np.flatnonzero(np.diff(ends)):  # pieces shorter than most stand with the others
        own = level[ends[g] : ends[g + 1]]
        np.maximum(own, int(np.median(own)), out=own)
        top[g] = own.max()
    small = np.zeros(len(column), dtype=bool)
    first = ring_ends[:-1]
    last = np.maximum(ring_ends[1:] - 1, first)
    size, left = np.diff(ring_ends), np.diff(np.concatenate([[0], np.cumsum(keep)])[ring_ends])
    for r in np.flatnonzero((size > RING_POINTS) & (left <= RING_POINTS)):
        if x[first[r]] == x[last[r]] and y[first[r]] == y[last[r]]:
            small[np.searchsorted(point_ends, first[r], "right") - 1] = True
    parts = [pa.array(v, t) for v, t in ((a - point_ends[owner], pa.int32()), (b - point_ends[owner], pa.int32()), (x[a], pa.float64()), (y[a], pa.float64()), (x[b], pa.float64()), (y[b], pa.float64()), (level, pa.int32()))]
    pieces = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(parts, PIECE.names))
    flags = pa.ListArray.from_arrays(pa.array(point_ends, pa.int32()), pa.array(keep))
    return pa.StructArray.from_arrays([flags, pa.array(small), pieces, pa.array(top, pa.int32())], DRAWN.names)


def _finished(column: pa.Array, flags: pa.Array, again: pa.Array, tolerance: float) -> pa.Array:
    points, x, y, geometry_ends, polygon_ends, ring_ends = _parts(column)
    keep = _members(flags).to_numpy(zero_copy_only=False).astype(bool)
    for g in np.flatnonzero(again.to_numpy(zero_copy_only=False)):
        bounds = ring_ends[polygon_ends[geometry_ends[g]] : polygon_ends[geometry_ends[g + 1]] + 1]
        begin, end = bounds[0], bounds[-1]
        keep[begin:end] = _kept(x[begin:end], y[begin:end], bounds - begin, tolerance)
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    new_points = points.filter(pa.array(keep))
    new_rings = pa.ListArray.from_arrays(pa.array(kept_before[ring_ends], pa.int32()), new_points)
    new_polygons = pa.ListArray.from_arrays(pa.array(polygon_ends, pa.int32()), new_rings)
    missing = column.is_null() if column.null_count else None
    return pa.ListArray.from_arrays(pa.array(geometry_ends, pa.int32()), new_polygons, mask=missing)


def _halved(x: np.ndarray, y: np.ndarray, bounds: np.ndarray, tolerance: float) -> np.ndarray:
    """Which vertices stay if no shortcut meets anything: all rings of a batch at once.

    Every round splits the sections whose farthest vertex is out of tolerance and
    drops the inner vertices of the others.
    """
    keep = np.zeros(len(x), dtype=bool)
    sized = np.diff(bounds) > 0
    first, last = bounds[:-1][sized], bounds[1:][sized] - 1
    keep[first] = keep[last] = True
    # A closed ring splits at least once, and then its first half does.
    forced = (x[first] == x[last]) & (y[first] == y[last])
    for depth in range(1, len(x) + 1):
        long = last - first > 1
        first, last, forced = first[long], last[long], forced[long]
        if first.size == 0:
            break
        sizes = last - first - 1
        starts = np.cumsum(sizes) - sizes
        inner = np.arange(sizes.sum()) + np.repeat(first + 1 - starts, sizes)
        away = _segment_distance(x, y, np.repeat(first, sizes), np.repeat(last, sizes), inner)
        farthest = np.maximum.reduceat(away, starts)
        at = np.where(away == np.repeat(farthest, sizes), inner, len(x))
        split = np.minimum.reduceat(at, starts)
        go = (farthest > tolerance) | forced
        keep[split[go]] = True
        first, last, split, forced = first[go], last[go], split[go], forced[go]
        again = forced if depth == 1 else np.zeros(first.size, dtype=bool)
        first, last = np.concatenate([first, split]), np.concatenate([split, last])
        forced = np.concatenate([again, np.zeros(again.size, dtype=bool)])
    return keep


def _any_meeting(x, y, i, j, a, b) -> bool:
    """Does any segment i-j meet any segment a-b that lies outside i..j?"""
    low_x, high_x = np.minimum(x[i], x[j])[:, None], np.maximum(x[i], x[j])[:, None]
    low_y, high_y = np.minimum(y[i], y[j])[:, None], np.maximum(y[i], y[j])[:, None]
    near = (np.maximum(x[a], x[b]) >= low_x) & (np.minimum(x[a], x[b]) <= high_x)
    near &= (np.maximum(y[a], y[b]) >= low_y) & (np.minimum(y[a], y[b]) <= high_y)
    near &= (b <= i[:, None]) | (a >= j[:, None])
    cut, piece = np.nonzero(near)
    return bool(np.any(_meet(x, y, i[cut], j[cut], a[piece], b[piece])))


def _members(lists: pa.ListArray) -> pa.Array:
    """The lists' members in a row. Lists that came empty over the wire may lack even their offsets."""
    return lists.flatten() if len(lists) else pa.array([], lists.type.value_type)


def _lengths(lists: pa.ListArray) -> np.ndarray:
    if len(lists) == 0:
        return np.zeros(0, dtype=np.int64)
    return lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)


def _kept(x: np.ndarray, y: np.ndarray, bounds: np.ndarray, tolerance: float) -> np.ndarray:
    """Which vertices of one geometry stay, shortcut by shortcut; ``bounds`` delimits its rings."""
    alive = np.ones(len(x), dtype=bool)
    ring_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    pieces = _Pieces(x, y, np.flatnonzero(ring_of[:-1] == ring_of[1:]))
    for begin, end in zip(bounds[:-1], bounds[1:]):
        if end - begin < 3:
            continue
        closed = x[begin] == x[end - 1] and y[begin] == y[end - 1]
        least = RING_POINTS if closed else LINE_POINTS
        settled = 0  # pieces of the new outline so far
        todo = [(begin, end - 1, 1)]
        while todo:
            i, j, depth = todo.pop()
            if j - i == 1:
                settled += 1
                continue
            away = _segment_distance(x, y, i, j, np.arange(i + 1, j))
            far = int(np.argmax(away))
            reached = settled + 1 if settled else 0
            too_few = reached < least and depth + 1 < least
            if too_few or away[far] > tolerance or pieces.meet(i, j):
                split = i + 1 + far
                todo += [(split, j, depth + 1), (i, split, depth + 1)]
            else:
                alive[i + 1 : j] = False
                pieces.replace(i, j)
                settled += 1
    return alive


class _Pieces:
    """The pieces of an outline as it stands, by the cells of a grid that their boxes touch."""

    def __init__(self, x: np.ndarray, y: np.ndarray, starts: np.ndarray):
        self.x, self.y, self.end = x, y, {}
        self.cells: dict[tuple[int, int], set[int]] = {}
        self.long: set[int] = set()
        extent = np.maximum(np.abs(np.diff(x)), np.abs(np.diff(y)))[starts]
        middle = float(np.median(extent[extent > 0])) if np.any(extent > 0) else 1.0
        self.size = 4 * middle
        for a in starts.tolist():
            self._add(a, a + 1)

    def _box(self, a: int, b: int) -> tuple[range, range]:
        spans = (sorted((v[a] // self.size, v[b] // self.size)) for v in (self.x, self.y))
        return tuple(range(int(low), int(high) + 1) for low, high in spans)

    def _add(self, a: int, b: int) -> None:
        self.end[a] = b
        across, up = self._box(a, b)
        if len(across) * len(up) > CELLS_OF_PIECE:
            self.long.add(a)
            return
        for cx in across:
            for cy in up:
                self.cells.setdefault((cx, cy), set()).add(a)

    def replace(self, i: int, j: int) -> None:
        """The shortcut i-j instead of the pieces between."""
        for a in range(i, j):
            across, up = self._box(a, self.end.pop(a))
            self.long.discard(a)
            for cx in across if len(across) * len(up) <= CELLS_OF_PIECE else ():
                for cy in up:
                    self.cells[cx, cy].discard(a)
        self._add(i, j)

    def meet(self, i: int, j: int) -> bool:
        """Would the shortcut i-j run into a piece outside i..j?"""
        across, up = self._box(i, j)
        if len(across) * len(up) > CELLS_OF_SEARCH:
            near = set(self.end)
        else:
            near = self.long.union(*(self.cells.get((cx, cy), ()) for cx in across for cy in up))
        a = np.fromiter(near, dtype=np.int64, count=len(near))
        b = np.array([self.end[k] for k in near], dtype=np.int64)
        return bool(len(a)) and _any_meeting(self.x, self.y, np.array([i]), np.array([j]), a, b)


def _segment_distance(x: np.ndarray, y: np.ndarray, i, j, p) -> np.ndarray:
    """Distance of the vertices p from the segments i-j."""
    px, py = x[p] - x[i], y[p] - y[i]
    dx, dy = x[j] - x[i], y[j] - y[i]
    length2 = dx * dx + dy * dy
    along = np.clip((px * dx + py * dy) / np.where(length2 == 0.0, 1.0, length2), 0.0, 1.0)
    ex, ey = px - along * dx, py - along * dy
    return np.sqrt(ex * ex + ey * ey)


def _meet(x, y, i, j, a, b):
    """Segments i-j and a-b cross, or an end of one lies inside the other."""
    side_a, side_b = _side(x, y, i, j, a), _side(x, y, i, j, b)
    side_i, side_j = _side(x, y, a, b, i), _side(x, y, a, b, j)
    crossing = (side_a * side_b < 0) & (side_i * side_j < 0)
    touching = (
        _strictly_on(x, y, i, j, a, side_a) | _strictly_on(x, y, i, j, b, side_b)
        | _strictly_on(x, y, a, b, i, side_i) | _strictly_on(x, y, a, b, j, side_j)
    )
    return crossing | touching


def _side(x, y, p, q, r):
    """Sign of the turn p -> q -> r."""
    return np.sign((x[q] - x[p]) * (y[r] - y[p]) - (y[q] - y[p]) * (x[r] - x[p]))


def _strictly_on(x, y, p, q, r, side):
    """r lies inside the segment p-q, not at its ends."""
    dx, dy = x[q] - x[p], y[q] - y[p]
    reach = (x[r] - x[p]) * dx + (y[r] - y[p]) * dy
    whole = dx * dx + dy * dy
    return (side == 0) & (reach > 0) & (reach < whole)


# --- well-known binary ------------------------------------------------------


@F.arrow_udf(GEOMETRY)
def from_wkb(column: pa.Array) -> pa.Array:
    """Polygon or MultiPolygon in well-known binary -> geometry; null stays null."""
    polygons, rings, points = [], [], []  # members of every geometry, polygon and ring
    for value in column:
        if value.is_valid:
            sizes, found = _read_wkb(value.as_buffer())
            polygons.append(len(sizes))
            rings += sizes
            points += found
        else:
            polygons.append(0)
    flat = np.concatenate(points) if points else np.empty((0, 2))
    inner = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], fields=list(_ARROW_POINT))
    for sizes in ([len(p) for p in points], rings):
        inner = pa.ListArray.from_arrays(_ends(sizes), inner)
    missing = column.is_null() if column.null_count else None
    return pa.ListArray.from_arrays(_ends(polygons), inner, mask=missing)


def _ends(sizes: list[int]) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), pa.int32())


def _read_wkb(data) -> tuple[list[int], list[np.ndarray]]:
    """Rings per polygon, and the points of every ring."""
    order = "<" if data[0] == 1 else ">"
    (kind,) = struct.unpack_from(order + "I", data, 1)
    if kind == WKB_POLYGON:
        rings, _ = _read_polygon(data, 0)
        return [len(rings)], rings
    if kind != WKB_MULTIPOLYGON:
        raise ValueError(f"geometry type {kind} is neither polygon nor multi-polygon")
    (parts,) = struct.unpack_from(order + "I", data, 5)
    sizes, points, at = [], [], 9
    for _ in range(parts):
        rings, at = _read_polygon(data, at)
        sizes.append(len(rings))
        points += rings
    return sizes, points


def _read_polygon(data, at: int) -> tuple[list[np.ndarray], int]:
    order = "<" if data[at] == 1 else ">"
    (ring_count,) = struct.unpack_from(order + "I", data, at + 5)
    at, rings = at + 9, []
    for _ in range(ring_count):
        (size,) = struct.unpack_from(order + "I", data, at)
        flat = np.frombuffer(data, order + "f8", 2 * size, at + 4)
        rings.append(flat.reshape(-1, 2).astype("=f8"))
        at += 4 + 16 * size
    return rings, at


@F.arrow_udf(T.BinaryType())
def to_wkb(column: pa.Array) -> pa.Array:
    """Geometry -> well-known binary: Polygon for one part, MultiPolygon otherwise."""
    polygons = _members(column)
    rings = _members(polygons)
    points = _members(rings)
    flat = np.column_stack([points.field(i).to_numpy(zero_copy_only=False) for i in (0, 1)]).astype("<f8")
    geometry_ends, polygon_ends, ring_ends = (
        np.concatenate([[0], np.cumsum(_lengths(a))]) for a in (column, polygons, rings)
    )

    def polygon(p: int) -> bytes:
        out = [struct.pack("<BII", 1, WKB_POLYGON, polygon_ends[p + 1] - polygon_ends[p])]
        for r in range(polygon_ends[p], polygon_ends[p + 1]):
            ring = flat[ring_ends[r] : ring_ends[r + 1]]
            out += [struct.pack("<I", len(ring)), ring.tobytes()]
        return b"".join(out)

    def whole(first: int, last: int) -> bytes:
        parts = [polygon(p) for p in range(first, last)]
        if len(parts) == 1:
            return parts[0]
        return struct.pack("<BII", 1, WKB_MULTIPOLYGON, len(parts)) + b"".join(parts)

    valid = column.is_valid().to_numpy(zero_copy_only=False)
    ends = zip(geometry_ends[:-1], geometry_ends[1:])
    return pa.array([whole(a, b) if ok else None for ok, (a, b) in zip(valid, ends)], pa.binary())


# --- measures and join ------------------------------------------------------


def point_count(geometry: Column) -> Column:
    return F.size(F.flatten(F.flatten(geometry)))


def join_geometry(gold: DataFrame, geo: DataFrame, key: str) -> DataFrame:
    """Left-join polygons by integer key. Polygons are wide, so neither side is forced.

    Both keys become 64-bit integers; one that is no integer fails the job.
    """
    left = gold.withColumn(key, F.col(key).cast("bigint"))
    right = geo.withColumn(key, F.col(key).cast("bigint"))
    return left.join(right, key, "left")
