"""Documents that hold benchmark items, found by greedy string tiling.

A document and an item that share a run of ``seed`` words are a candidate pair; these come from a
join of the hashes of their runs. A bitmap of the items' hashes, of bounded size, keeps the runs that no item
has out of the join. For each pair, tiles are then marked from the longest common run to the shortest, none overlapping, each
found by Karp-Rabin hashes of runs; the share of the item's words under tiles is its
coverage. Moved sentences keep their tiles, so a shuffled copy is covered as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import packed, staged, text_or_empty

TOKEN = re.compile(r"\w+")
#: Karp-Rabin arithmetic is modulo 2**64; equal hashes are compared word by word.
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bits for each run of the items in the bitmap, and the most it may have (128 MB).
BITS_OF_RUN, MOST_BITS = 16, 1 << 30
#: Bits of one bitmap as Spark makes them.
PAGE = 1 << 15
#: Bytes of items, pairs or results that are sent to the tasks; more are joined by a shuffle.
SENT = 1 << 26
#: Words whose hashes a worker remembers.
KNOWN = 500_000


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def run_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``length`` words; built by doubling, so it costs a few passes."""
    if length < 1 or len(ids) < length:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        power, size = ids.astype(np.uint64) + np.uint64(1), 1
        out, done, base = None, 0, BASE
        left = length
        while left:
            if left & 1:
                n = len(ids) - (done + size) + 1
                out = power[:n] if out is None else out[:n] * base + power[done : done + n]
                done += size
            left >>= 1
            if left:
                power = power[: len(power) - size] * base + power[size:]
                base, size = base * base, size * 2
        return out


def tile(doc: np.ndarray, item: np.ndarray, shortest: int) -> np.ndarray:
    """Mask of the item's words that lie under tiles of at least ``shortest`` words.

    Longest common runs of unmarked words come first; of equal ones the first in the item, then in the
    document. Ids below zero match nothing.
    """
    doc_free, item_free = doc >= 0, item >= 0
    length = _longest(doc, item, doc_free, item_free, shortest, min(len(doc), len(item)))
    while length >= shortest:
        for p, q in _matches(doc, item, doc_free, item_free, length):
            if doc_free[q : q + length].all() and item_free[p : p + length].all():
                doc_free[q : q + length] = False
                item_free[p : p + length] = False
        length = _longest(doc, item, doc_free, item_free, shortest, length - 1)
    return (item >= 0) & ~item_free


def _open_runs(free: np.ndarray, length: int) -> np.ndarray:
    """Where a run of ``length`` unmarked words starts."""
    if length > len(free):
        return np.zeros(0, dtype=np.int64)
    taken = np.concatenate([[0], np.cumsum(~free)])
    return np.flatnonzero(taken[length:] == taken[: len(taken) - length])


def _matches(doc, item, doc_free, item_free, length: int) -> Iterator[tuple[int, int]]:
    """Equal unmarked runs of the length, by place in the item, then in the document; hash matches are verified."""
    a, b = _open_runs(item_free, length), _open_runs(doc_free, length)
    if not len(a) or not len(b):
        return
    ha, hb = run_hashes(item, length)[a], run_hashes(doc, length)[b]
    order = np.argsort(hb, kind="stable")
    low, high = np.searchsorted(hb[order], ha, "left"), np.searchsorted(hb[order], ha, "right")
    for k in np.flatnonzero(high > low):
        p = int(a[k])
        for q in b[order[low[k] : high[k]]].tolist():
            if not item_free[p : p + length].all():
                break
            if np.array_equal(item[p : p + length], doc[q : q + length]):
                yield p, q


def _longest(doc, item, doc_free, item_free, low: int, high: int) -> int:
    """The greatest length with an equal unmarked run, by bisection (a run's parts match as well); 0 below ``low``."""
    if high < low or next(_matches(doc, item, doc_free, item_free, low), None) is None:
        return 0
    while low < high:
        middle = (low + high + 1) // 2
        if next(_matches(doc, item, doc_free, item_free, middle), None) is None:
            high = middle - 1
        else:
            low = middle
    return low


class Hashes(dict):
    """64-bit hashes of words, remembered; emptied when there are many."""

    def __missing__(self, word: str) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) > KNOWN:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def covered_share(doc: list[str], item: list[str], seed: int) -> float:
    """Share of the item's words under tiles of at least ``seed`` words, or of the whole item if it is shorter."""
    if not item:
        return 0.0
    known: dict[str, int] = {}
    wanted = np.array([known.setdefault(w, len(known)) for w in item], dtype=np.int64)
    own = np.array([known.get(w, -1) for w in doc], dtype=np.int64)
    return float(tile(own, wanted, min(seed, len(item))).sum() / len(item))


RUN = "length int, run long"


def _runs(found: list[np.ndarray], lengths: list[int]) -> list[pa.Array]:
    """The columns of ``RUN`` for the runs found of each length."""
    of = np.repeat(np.array(lengths, dtype=np.int32), [len(f) for f in found])
    return [pa.array(of), pa.array(np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64))]


def item_runs(items: DataFrame, seed: int) -> DataFrame:
    """``item, length, run``: the different runs of ``seed`` words of every item (``item, words``), or the whole of a shorter one."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in source:
            texts = [tokens(t) for t in batch.column("text").to_pylist()]
            lengths = [min(seed, len(t)) for t in texts]
            found = [np.unique(run_hashes(hashes.of(t), n)) for t, n in zip(texts, lengths)]
            owner = np.repeat(np.arange(len(texts)), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([batch.column("item").take(pa.array(owner)), *_runs(found, lengths)], ["item", "length", "run"])

    return items.select("item", "text").mapInArrow(batches, f"item long, {RUN}")


def _bitmap(runs: DataFrame) -> np.ndarray:
    """One bit for each run's hash modulo the number of bits, a power of two that follows the number of runs up to a limit."""
    bits = 1 << 16
    count = runs.count()
    while bits < min(MOST_BITS, BITS_OF_RUN * count):
        bits *= 2
    at = F.pmod(F.col("run"), F.lit(bits))
    found = runs.groupBy(F.floor(at / PAGE).alias("page")).agg(F.bitmap_construct_agg(F.pmod(at, F.lit(PAGE))).alias("bits"))
    out = np.zeros((bits // PAGE, PAGE // 8), dtype=np.uint8)
    for row in found.toLocalIterator():  # MOST_BITS / PAGE rows at the most
        out[row["page"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out.ravel()


def document_runs(rows: DataFrame, lengths: list[int], bitmap: np.ndarray) -> DataFrame:
    """``_id, _own, length, run``: the different runs of every row (``_id, _own, _text``) that the bitmap knows."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known = Hashes(), shared.value
        mask = np.uint64(8 * len(known) - 1)
        for batch in source:
            owners, columns = [], [[], []]
            for k, text in enumerate(batch.column("_text").to_pylist()):
                words = hashes.of(tokens(text))
                for length in lengths:
                    runs = run_hashes(words, length)
                    at = runs & mask
                    hit = np.unique(runs[(known[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1])
                    if len(hit):
                        owners.append(np.full(len(hit), k))
                        columns[0].append(hit)
                        columns[1].append(length)
            owner = pa.array(np.concatenate(owners) if owners else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("_id").take(owner), batch.column("_own").take(owner), *_runs(*columns)], ["_id", "_own", "length", "run"])

    return rows.mapInArrow(batches, f"_id long, _own long, {RUN}")


def _sent(df: DataFrame, size: Column, most: int) -> DataFrame:
    """A stored table, to be sent to the tasks if its rows have at most ``most`` bytes together."""
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= most else df


def _tiled(seed: int):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, words = None, []
        for batch in source:
            shares = []
            for text, item in zip(batch.column("_text").to_pylist(), batch.column("text").to_pylist()):
                if text != last:
                    last, words = text, tokens(text)
                shares.append(covered_share(words, tokens(item), seed))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("_id", "_own", "item_id")), pa.array(shares, pa.float64())], ["_id", "_own", "item", "covered"])

    return batches


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    seed: int = 5,
    coverage: float = 0.5,
    sent: int = SENT,
) -> DataFrame:
    """All columns of ``docs`` with ``item_ids`` (covered items, ascending), ``best_item``, ``coverage`` and ``contaminated``.

    An item counts when tiles of at least ``seed`` words cover ``coverage`` of its words; an item shorter than
    ``seed`` words must occur whole. ``best_item`` is the best covered one (of equals the smallest id), null if no
    item shares a tile, then with coverage 0. Items without id or words are ignored; null and empty texts are clean;
    of an id that several items have, each counts. Repeated rows get the same results. Up to ``sent`` bytes of
    items, candidate pairs and results are sent to the tasks, more are joined by a shuffle; the benchmark does not pass
    through the driver.
    """
    results = ("item_ids", "best_item", "coverage", "contaminated")
    items = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), text_or_empty(f"`{item_text}`").alias("text"))
    items = staged(items.where("item_id IS NOT NULL").distinct().withColumn("item", F.monotonically_increasing_id()), "items")
    runs = staged(item_runs(items, seed).where("length > 0"), "item-runs")
    lengths = sorted(r["length"] for r in runs.select("length").distinct().collect())
    key = [F.col(f"`{doc_id}`").cast("long").alias("_id"), F.xxhash64(text_or_empty(f"`{text}`")).alias("_own")]
    rows = docs.select(*key, text_or_empty(f"`{text}`").alias("_text"))
    hits = document_runs(rows, lengths, _bitmap(runs))
    found = hits.join(_sent(runs, F.lit(24), sent), ["length", "run"]).select("_id", "_own", "item").distinct()
    pairs = staged(found.select(F.col("_id").alias("_doc"), F.col("_own").alias("_body"), "item"), "pairs")
    same = F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_own") == F.col("_body"))
    wanted = rows.join(_sent(pairs, F.lit(24), sent), same).select("_id", "_own", "_text", "item")
    both = wanted.join(_sent(items, F.octet_length("text") + 16, sent), "item").select("_id", "_own", "_text", "item_id", "text")
    tiled = both.mapInArrow(_tiled(seed), "_id long, _own long, item long, covered double").where("covered > 0").distinct()
    each = tiled.groupBy(F.col("_id").alias("_doc"), F.col("_own").alias("_body")).agg(F.collect_list(F.struct("item", "covered")).alias("_tiles"))
    tiles = staged(each, "tiles")
    own = docs.select(packed(docs, text, *results), F.col(f"`{text}`").alias("_text"), *key)
    marked = own.join(_sent(tiles, 16 * F.size("_tiles") + 16, sent), same, "left")
    none = F.array().cast("array<struct<item: long, covered: double>>")
    marked = marked.withColumn("_tiles", F.coalesce("_tiles", none))
    best = F.array_max(F.transform("_tiles", lambda t: F.struct(t["covered"].alias("c"), (-t["item"]).alias("i"))))
    hits = F.filter("_tiles", lambda t: t["covered"] >= coverage)
    return marked.select(
        *(F.col("_text").alias(text) if c == text else F.col("own").getField(c).alias(c) for c in docs.columns if c not in results),
        F.array_sort(F.array_distinct(F.transform(hits, lambda t: t["item"]))).alias("item_ids"),
        (-best["i"]).alias("best_item"),
        F.coalesce(best["c"], F.lit(0.0)).alias("coverage"),
        (F.size(hits) > 0).alias("contaminated"),
    )
