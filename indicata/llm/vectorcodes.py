"""Vectors as short codes: the nearest codebook entry of each of their parts, found by equal-average search.

All arithmetic is on integers. A codebook's entries are sorted by the sum of their components; the
search for a part starts at the part's own sum and goes outward. The squared gap between two sums, over
the number of components, is a lower bound of the squared distance, so a part is done as soon as that
bound strictly exceeds the best distance on both sides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import dealt_join, first_rows, packed, staged, unpacked

#: Parts of neighbouring sums that are searched together, and entries looked at in one step.
TILE, STEP = 256, 32
#: Sums travel as digits of so many bits, so that integers of any size add up exactly.
DIGIT = 40
LONGEST = (1 << 63) - 1


def integers(flat: np.ndarray, scale: int = 1024) -> np.ndarray:
    """``floor(scale * x)``: doubles while every integer is exact in one, else Python integers."""
    flat = flat.astype(np.float64)
    if len(flat) == 0 or np.abs(flat).max() < 2.0**40:
        return np.floor(flat * scale)
    return np.array([int(np.floor(x * scale)) if abs(x) < 2.0**40 else int(x) * scale for x in flat.tolist()], dtype=object)


def _exact(*arrays: np.ndarray) -> bool:
    """Whether squared distances between rows of the arrays are exact in doubles."""
    if any(a.dtype == object for a in arrays):
        return False
    most = max((np.abs(a).max() for a in arrays if a.size), default=0.0)
    return 4 * max(a.shape[1] for a in arrays) * most * most < 2.0**52


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (the lower one on ties) and the squared distance of every part."""
    if not _exact(parts, entries):
        return _nearest_plain(parts, entries)
    width = parts.shape[1]
    sums = entries.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    entries, entry_sums = entries[order], sums[order]
    entry_squares = (entries * entries).sum(axis=1)
    at, best = np.full(len(parts), len(order), dtype=np.int64), np.full(len(parts), np.inf)
    part_sums = parts.sum(axis=1)
    ranked = np.argsort(part_sums, kind="stable")
    for start in range(0, len(parts), TILE):
        live = ranked[start : start + TILE]
        lo = hi = int(np.searchsorted(entry_sums, np.median(part_sums[live])))
        while len(live) and (lo > 0 or hi < len(order)):
            centre = np.median(part_sums[live])
            left = lo > 0 and (hi == len(order) or centre - entry_sums[lo - 1] <= entry_sums[hi] - centre)
            block = np.arange(max(0, lo - STEP), lo) if left else np.arange(hi, min(len(order), hi + STEP))
            lo, hi = (int(block[0]), hi) if left else (lo, int(block[-1]) + 1)
            block = block[np.argsort(order[block])]  # the first of equal distances is the lower index
            x = parts[live]
            far = (x * x).sum(axis=1)[:, None] + entry_squares[block][None, :] - 2 * (x @ entries[block].T)
            pick = far.argmin(axis=1)
            found, index = far[np.arange(len(live)), pick], order[block][pick]
            better = (found < best[live]) | ((found == best[live]) & (index < at[live]))
            at[live[better]], best[live[better]] = index[better], found[better]
            below = np.maximum(0, part_sums[live] - entry_sums[lo - 1]) if lo else np.inf
            above = np.maximum(0, entry_sums[hi] - part_sums[live]) if hi < len(order) else np.inf
            gap = np.minimum(below, above) + np.zeros(len(live))
            live = live[~(gap * gap > width * best[live])]
    return at, best


def _nearest_plain(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same search part by part in integers of any size."""
    whole = [[int(v) for v in row] for row in entries.tolist()]
    order = sorted((sum(row), k) for k, row in enumerate(whole))
    sums = [s for s, _ in order]
    at, best = np.zeros(len(parts), dtype=np.int64), np.zeros(len(parts), dtype=object)
    for row, part in enumerate(parts.tolist()):
        part = [int(v) for v in part]
        own, found = sum(part), None
        hi = next((k for k, s in enumerate(sums) if s >= own), len(sums))
        lo = hi - 1
        while lo >= 0 or hi < len(sums):
            left = lo >= 0 and (hi == len(sums) or own - sums[lo] <= sums[hi] - own)
            k = lo if left else hi
            if found is not None and (own - sums[k]) ** 2 > len(part) * found[0]:
                break
            index = order[k][1]
            far = sum((a - b) ** 2 for a, b in zip(part, whole[index]))
            found = min(found, (far, index)) if found is not None else (far, index)
            lo, hi = (lo - 1, hi) if left else (lo, hi + 1)
        best[row], at[row] = found
    return at, best


@dataclass
class Codebooks:
    """One array of entries for each part of a vector."""

    books: list[np.ndarray]
    scale: int = 1024

    @property
    def edges(self) -> list[int]:
        return [0, *np.cumsum([b.shape[1] for b in self.books]).tolist()]

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every part (columns) of the integer rows."""
        edges = self.edges
        found = [nearest(rows[:, a:b], book) for a, b, book in zip(edges, edges[1:], self.books)]
        return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)

    def decode(self, code: str) -> list[float]:
        """The vector that a code stands for: the middle of the integers' cells."""
        picked = (book[int(code[2 * k : 2 * k + 2], 16)] for k, book in enumerate(self.books))
        return [(int(v) + 0.5) / self.scale for entry in picked for v in entry]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for book in self.books for v in book.ravel().tolist()).encode()).hexdigest()


def _rows(batch: pa.RecordBatch, dim: int, scale: int) -> np.ndarray:
    return integers(batch.column("v").flatten().to_numpy(zero_copy_only=False), scale).reshape(batch.num_rows, dim)


def usable(vector: str) -> F.Column:
    """Not null, and no component null or not finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(F.col(vector), finite), F.lit(False))


def train(vectors: DataFrame, parts: int = 4, size: int = 256, rounds: int = 4, scale: int = 1024) -> Codebooks:
    """Codebooks of usable, stored vectors (``id``, ``v``) of one length.

    They start as the parts of the vectors with the ``size`` smallest ids (nulls last, then by vector). A round assigns all
    parts and replaces every used entry by the floor of its parts' mean. What reaches the driver is one row for each
    entry and digit, whatever the number of vectors.
    """
    first = [r["v"] for r in first_rows(vectors, size, "id", "v").select("v").collect()]
    dim = len(first[0]) if first else 0
    start = integers(np.array(first, dtype=np.float64).ravel(), scale).reshape(len(first), dim)
    edges = [dim * k // parts for k in range(parts + 1)]
    books = Codebooks([start[:, a:b].copy() for a, b in zip(edges, edges[1:])], scale)
    for _ in range(rounds if first else 0):
        books = _moved(vectors, books, dim)
    return books


def _moved(vectors: DataFrame, books: Codebooks, dim: int) -> Codebooks:
    edges, wide = books.edges, max((b.shape[1] for b in books.books), default=0)

    def sums(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), dtype=np.int64) for b in books.books]
        totals = [np.zeros(b.shape, dtype=object) for b in books.books]
        for batch in source:
            rows = _rows(batch, dim, books.scale)
            at, _ = books.assign(rows)
            for p, (a, b) in enumerate(zip(edges, edges[1:])):
                counts[p] += np.bincount(at[:, p], minlength=len(counts[p]))
                if rows.dtype == object or rows.size and np.abs(rows).max() * len(rows) >= 2.0**52:
                    np.add.at(totals[p], at[:, p], np.vectorize(int, otypes=[object])(rows[:, a:b]) if b > a else rows[:, a:b].astype(object))
                else:
                    added = [np.bincount(at[:, p], rows[:, j], len(counts[p])) for j in range(a, b)]
                    totals[p] += np.array(added, dtype=np.int64).reshape(b - a, len(counts[p])).T
        for p, (count, total) in enumerate(zip(counts, totals)):
            used = np.flatnonzero(count)
            digit, left = 0, [[int(v) for v in row] for row in total[used].tolist()]
            while digit == 0 or any(any(row) for row in left):
                low = [[v & ((1 << DIGIT) - 1) for v in row] for row in left]
                left = [[v >> DIGIT for v in row] for row in left]
                if all(v in (0, -1) for row in left for v in row):  # the sign goes with the last digit
                    low = [[v + (w << DIGIT) for v, w in zip(*pair)] for pair in zip(low, left)]
                    left = []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), p), pa.int32()), pa.array(used, pa.int32()), pa.array([digit] * len(used), pa.int32()), pa.array(count[used]), pa.array(low, pa.list_(pa.int64()))],
                    ["part", "entry", "digit", "n", "s"],
                )
                digit += 1

    found = vectors.select("v").mapInArrow(sums, "part int, entry int, digit int, n long, s array<long>")
    total = found.groupBy("part", "entry", "digit").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.get("s", F.lit(k))) for k in range(wide))).alias("s"))
    held: dict[tuple[int, int], tuple[int, list[int]]] = {}
    for row in total.orderBy("digit").toLocalIterator():
        key, digits = (row["part"], row["entry"]), [(v or 0) << (DIGIT * row["digit"]) for v in row["s"]]
        n, s = held.get(key, (row["n"], [0] * wide))
        held[key] = (n, [x + y for x, y in zip(s, digits)])
    moved = []
    for p, book in enumerate(books.books):
        entries = [[int(v) for v in entry] for entry in book.tolist()]
        for k in range(len(entries)):
            if (p, k) in held:
                n, s = held[p, k]
                entries[k] = [v // n for v in s[: book.shape[1]]]
        big = any(abs(v) >= 1 << 50 for entry in entries for v in entry)
        moved.append(np.array(entries, dtype=object if big else np.float64).reshape(book.shape))
    return Codebooks(moved, books.scale)


def vector_codes(table: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 4, size: int = 256, rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, Codebooks]:
    """All columns of the rows with a usable vector, ``code`` (two hex digits for each part, so ``size`` is 256 at most),
    ``error`` (squared distance to the code, in squared integers) and ``label_error`` (errors summed over equal labels, nulls
    together); and the codebooks.

    Rows whose vector is null, or has a component that is null or not finite, are left out. A vector of another length than that
    of the smallest id keeps its row with null code and error. Parts are nearly equal where the length is no multiple of their
    number. Fewer than ``size`` rows make a smaller codebook, none an empty result. Repeated rows count as often as they
    stand. Errors beyond a long are given as the largest long. Columns named like the results are replaced.
    """
    results = ("code", "error", "label_error")
    double = isinstance(table.schema[vector].dataType.elementType, (T.FloatType, T.DoubleType))
    values = F.col(f"`{vector}`") if double else F.col(f"`{vector}`").cast("array<double>")
    rows = table.select(packed(table, *results), F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").alias("group"), values.alias("v"))
    rows = staged(rows.where(usable("v")), "vectors")
    head = first_rows(rows, 1, "id", "v").select(F.size("v").alias("dim")).collect()
    dim = head[0]["dim"] if head else 0
    books = train(rows.where(F.size("v") == dim).select("id", "v"), parts, size, rounds, scale)
    schema = T.StructType([*rows.select("own", "group").schema.fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def coded(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            at, far = books.assign(_rows(batch, dim, scale))
            codes = [bytes(row).hex() for row in at.astype(np.uint8).tolist()]
            errors = [min(LONGEST, sum(int(v) for v in row)) for row in far.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column("own"), batch.column("group"), pa.array(codes, pa.string()), pa.array(errors, pa.int64())], ["own", "group", "code", "error"])

    found = rows.where(F.size("v") == dim).mapInArrow(coded, schema)
    other = rows.where(F.size("v") != dim).select("own", "group", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    found = staged(found.unionByName(other), "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONGEST).cast("decimal(38,0)")).cast("long")
    sums = found.groupBy("group").agg(F.count(F.lit(1)).alias("held"), total.alias("label_error"))
    joined = dealt_join(found, sums, ["group"], "held")
    return joined.select(*unpacked(table, *results), "code", "error", "label_error"), books
