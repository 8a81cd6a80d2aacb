"""Near copies of documents by SimHash, with a generalised pigeonhole search.

Two fingerprints within ``max_bits`` of each other agree, in at least one of ``m``
groups of bits, up to that group's threshold, whenever the thresholds of the groups
add up to ``max_bits - m + 1`` (a threshold of -1 leaves its group out). Correlated
bits share a group, so that the other groups are selective; every fingerprint gets the
thresholds that a dynamic program finds cheapest for it, given counts of group values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import staged, texts_of

BITS = 64
#: Windows hashed at once, so that a very long text needs no more memory than this.
BLOCK = 1 << 16


def fingerprint(text: str, shingle: int = 3) -> int:
    """SimHash of a text's word shingles, repeats counted; 0 for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    n = len(words) - size + 1
    votes = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, n, BLOCK):
        stop = min(n, start + BLOCK)
        part = words[start : stop + size - 1]
        joined = b" ".join(part)
        lengths = np.fromiter(map(len, part), dtype=np.int64, count=len(part)) + 1
        ends = np.cumsum(lengths)
        begins = ends - lengths
        spans = zip(begins[: stop - start].tolist(), (ends[size - 1 :] - 1).tolist())
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], dtype="<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little")


def signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, fp, body`` of every row; ``fp`` holds the 64 bits as a signed long, ``body`` is a hash of the text."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(source, "text"):
            found = pa.array([signed(fingerprint(t, shingle)) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found, batch.column("body")], ["doc_id", "fp", "body"])

    own = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), own.alias("text"), F.xxhash64(F.coalesce(own, F.lit(""))).alias("body"))
    return rows.mapInArrow(batches, "doc_id long, fp long, body long")


# --- bit groups and thresholds ------------------------------------------------------------------


@dataclass(frozen=True)
class Groups:
    """Groups of bits, and counts of the values of at most eight bits of a group at a time."""

    bits: tuple[tuple[int, ...], ...]
    total: int = 0
    counts: tuple = ()  # per group, per chunk: one share for each value of the chunk

    def values(self, fps: np.ndarray) -> list[np.ndarray]:
        return [_gather(fps, group) for group in self.bits]

    def estimates(self, fps: np.ndarray, reach: int) -> list[list[np.ndarray]]:
        """Per group and radius 0..reach the fingerprints expected within the radius, chunks taken as independent."""
        out = []
        for group, chunks in zip(self.bits, self.counts):
            exact = [np.full(len(fps), float(self.total))] + [np.zeros(len(fps))] * reach
            for chunk, shares in zip(_chunks(group), chunks):
                at = _gather(fps, chunk).astype(np.int64)
                near = [shares[d][at] for d in range(reach + 1)]
                exact = [sum(exact[k] * near[d - k] for k in range(d + 1)) for d in range(reach + 1)]
            out.append([sum(exact[: d + 1]) for d in range(reach + 1)])
        return out


def _gather(fps: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(len(fps), dtype=np.uint64)
    for k, bit in enumerate(bits):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(k)
    return out


def _chunks(group: tuple[int, ...]) -> list[tuple[int, ...]]:
    return [group[k : k + 8] for k in range(0, len(group), 8)]


def _flips(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in pick) for pick in combinations(range(width), radius)]


def group_bits(joint: np.ndarray, n: int, m: int) -> tuple[tuple[int, ...], ...]:
    """``m`` groups of nearly equal size; each grows by the bit most correlated with it. ``joint``: rows with both bits set."""
    share = np.diag(joint) / max(n, 1)
    spread = np.sqrt(np.clip(share * (1 - share), 1e-12, None))
    corr = np.abs((joint / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    free, groups = set(range(BITS)), []
    for k in range(m):
        size = BITS // m + (k < BITS % m)
        first = max(sorted(free), key=lambda b: corr[b, sorted(free)].sum())
        group = [first]
        free.discard(first)
        while len(group) < size:
            nearest = max(sorted(free), key=lambda b: corr[b, group].sum())
            group.append(nearest)
            free.discard(nearest)
        groups.append(tuple(sorted(group)))
    return tuple(groups)


def thresholds(groups: Groups, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Per fingerprint the cheapest thresholds (one column per group), and their cost: keys probed plus rows expected."""
    m, n = len(groups.bits), len(fps)
    near = groups.estimates(fps, max_bits)
    keys = [[sum(len(_flips(len(g), r)) for r in range(t + 1)) for t in range(max_bits + 1)] for g in groups.bits]
    best = {0: (np.zeros(n), np.zeros((n, 0), dtype=np.int8))}
    for g in range(m):
        step: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, max_bits + 1):
                now = cost if t < 0 else cost + keys[g][t] + near[g][t]
                plan = np.hstack([chosen, np.full((n, 1), t, dtype=np.int8)])
                if spent + t in step:
                    old, old_plan = step[spent + t]
                    better = now < old
                    now, plan = np.where(better, now, old), np.where(better[:, None], plan, old_plan)
                step[spent + t] = (now, plan)
        best = step
    cost, plan = best[max_bits - m + 1]
    return plan, cost


def probes(groups: Groups, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group number, value and fingerprint of every key to look up."""
    plan, _ = thresholds(groups, fps, max_bits)
    which, value, owner = [], [], []
    for g, at in enumerate(groups.values(fps)):
        for radius in range(max_bits + 1):
            rows = plan[:, g] >= radius
            if rows.any():
                flips = np.array(_flips(len(groups.bits[g]), radius), dtype=np.uint64)
                value.append((at[rows][:, None] ^ flips[None, :]).ravel())
                owner.append(np.repeat(fps[rows], len(flips)))
                which.append(np.full(len(value[-1]), g, dtype=np.int32))
    empty = [np.zeros(0, dtype=np.uint64)]
    return np.concatenate(which or [np.zeros(0, np.int32)]), np.concatenate(value or empty), np.concatenate(owner or empty)


# --- statistics: sums of fixed size -------------------------------------------------------------


def _summed(fps: DataFrame, length: int, count) -> np.ndarray:
    """Adds up ``count(fingerprints)`` of all batches: ``length`` numbers, whatever the number of rows."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length, dtype=np.float64)
        for batch in source:
            total += count(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array(total[filled], pa.float64())], ["at", "n"])

    out = np.zeros(length)
    for row in fps.select("fp").mapInArrow(batches, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row["at"]] = row["n"]
    return out


def _joint_counts(values: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
    return np.append((bits.T @ bits).astype(np.float64).ravel(), len(values))


def _with_counts(fps: DataFrame, layouts: list[tuple], total: int, reach: int) -> list[Groups]:
    chunks = [c for layout in layouts for group in layout for c in _chunks(group)]

    def count(values: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(_gather(values, c).astype(np.int64), minlength=256) for c in chunks]).astype(np.float64)

    found = _summed(fps, 256 * len(chunks), count).reshape(-1, 256) / max(total, 1)
    out, k = [], 0
    for layout in layouts:
        groups = []
        for group in layout:
            shares = []
            for chunk in _chunks(group):
                size = 1 << len(chunk)
                own = found[k][:size]
                shares.append([sum(own[np.arange(size) ^ f] for f in _flips(len(chunk), r)) if len(chunk) >= r else np.zeros(size) for r in range(reach + 1)])
                k += 1
            groups.append(shares)
        out.append(Groups(layout, total, tuple(groups)))
    return out


def plan_groups(fps: DataFrame, max_bits: int) -> Groups:
    """The cheapest of the layouts with 2 to ``max_bits + 1`` groups, by the cost their thresholds have over all fingerprints."""
    joint = _summed(fps, BITS * BITS + 1, _joint_counts)
    total = int(joint[-1])
    counts = range(2, max(2, max_bits + 1) + 1)
    layouts = _with_counts(fps, [group_bits(joint[:-1].reshape(BITS, BITS), total, m) for m in counts], total, max_bits)
    costs = _summed(fps, len(layouts), lambda values: np.array([thresholds(g, values, max_bits)[1].sum() + len(g.bits) * len(values) for g in layouts]))
    return layouts[int(np.argmin(costs))]


# --- search ---------------------------------------------------------------------------------------


def links(fps: DataFrame, max_bits: int = 2, crowded: int = 256) -> DataFrame:
    """``a, b``: links between distinct fingerprints that connect all of them within ``max_bits`` bits.

    Outside crowded keys every link is found. Fingerprints that meet in a key of more than ``crowded``
    fingerprints are connected through the points half-way between them instead, one star for each point,
    which gives the same components without all pairs of the crowd.
    """
    groups = plan_groups(fps, max_bits)

    def probe_rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for start in range(0, len(values), 2000):
                which, value, owner = probes(groups, values[start : start + 2000], max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(value.view(np.int64)), pa.array(owner.view(np.int64))], ["g", "v", "q"])

    def index_rows(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for g, at in enumerate(groups.values(values)):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), g, np.int32)), pa.array(at.view(np.int64)), pa.array(values.view(np.int64))], ["g", "v", "fp"])

    index = fps.select("fp").mapInArrow(index_rows, "g int, v long, fp long")
    probe = fps.select("fp").mapInArrow(probe_rows, "g int, v long, q long")
    crowds = staged(index.groupBy("g", "v").count().where(F.col("count") > crowded).select("g", "v"), "crowds")
    near = F.bit_count(F.col("q").bitwiseXOR(F.col("fp"))) <= max_bits
    found = probe.join(crowds, ["g", "v"], "left_anti").join(index, ["g", "v"]).where((F.col("q") < F.col("fp")) & near).select(F.col("q").alias("a"), F.col("fp").alias("b"))
    members = index.join(crowds, ["g", "v"], "left_semi").select("fp").union(probe.join(crowds, ["g", "v"], "left_semi").select("q")).distinct()
    return found.union(_through_midpoints(members, max_bits))


def _through_midpoints(members: DataFrame, max_bits: int) -> DataFrame:
    """Two fingerprints are within ``max_bits`` exactly if some point is within half of it of one and the rest of the other.

    For even ``max_bits`` all members around a point are linked; a point has a bounded number of neighbours. For
    odd ``max_bits`` the larger half is taken from one side only and the pair is verified.
    """
    near, far = max_bits // 2, max_bits - max_bits // 2
    masks = {r: [signed(f) for k in range(r + 1) for f in _flips(BITS, k)] for r in (near, far)}

    def around(radius: int, name: str) -> DataFrame:
        flips = F.array(*(F.lit(f) for f in masks[radius]))
        return members.select(F.col("fp").alias(name), F.explode(flips).alias("flip")).select(name, F.col(name).bitwiseXOR(F.col("flip")).alias("point"))

    if near == far:
        points = around(near, "b")
        least = points.groupBy("point").agg(F.min("b").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
        return points.join(least, "point").where("a != b").select("a", "b").distinct()
    met = around(near, "a").join(around(far, "b"), "point")
    return met.where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b").distinct()


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 2, crowded: int = 256) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id`` (the smallest id reachable through links, its own included).

    Null and empty texts have the fingerprint 0 and are linked like any other. Repeated rows come back as often.
    A null id never becomes a component's id; a component of null ids alone has a null one.
    """
    return simhash_components(docs, doc_id, text, shingle, max_bits, crowded).select("doc_id", "fp", "component_id")


def simhash_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 2, crowded: int = 256) -> DataFrame:
    """``simhash_groups`` with ``root`` (a fingerprint that names the component) and ``body`` (a hash of the text)."""
    rows = staged(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    smallest = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(smallest, max_bits, crowded), "a", "b")
    rooted = smallest.join(roots, smallest["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    component = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(component, "root").select(F.col("fp").alias("_fp"), "component_id", "root")
    return rows.join(classes, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id", "root", "body")
