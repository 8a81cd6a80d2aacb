"""Text quality by a generalised additive model with pairwise interactions.

Shallow trees are boosted in cycles, one feature at a time, so each feature ends up with a
lookup table over its bins; the pairs of features that explain most of what is left get
tables of their own. A score is a sum of looked-up numbers.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import held_out, smallest_hashes, staged, texts_of

FEATURES = (
    "words chars word_length distinct_share short_share long_share upper_share digit_share symbol_share pipe_share bang_share stop_share "
    "comma_share high_share lines line_words line_spread same_lines same_windows capital_share top_share plain_share"
).split()

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[[ord(c) for c in "#*$%&<>{}[]\\^~_=+@"]] = True


@functools.cache
def _classes() -> dict[str, np.ndarray]:
    code = np.arange(256)
    return {
        "upper": (code >= 65) & (code <= 90),
        "lower": (code >= 97) & (code <= 122),
        "digit": (code >= 48) & (code <= 57),
        "high": code >= 0xC0,
        "start": (code & 0xC0) != 0x80,
        "white": (code == 32) | ((code >= 9) & (code <= 13)),
    }


def features(text: str) -> np.ndarray:
    """The numbers of ``FEATURES`` for one whole text; zeros for one without words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return np.zeros(len(FEATURES))
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    kind = {k: int(counts[m].sum()) for k, m in _classes().items()}
    n, chars = len(words), kind["start"] - kind["white"]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    lines = [line for line in raw.split(b"\n") if not line.isspace() and line]
    line_words = np.fromiter((line.count(b" ") + 1 for line in lines), dtype=np.int64, count=len(lines))
    codes = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=n)
    known, times = np.unique(codes, return_counts=True)
    windows = np.unique(codes[:-2] + (codes[1:-1] << 15) + (codes[2:] << 30), return_counts=True)[1] if n > 2 else np.ones(1)
    capital = sum(1 for w in words if 65 <= w[0] <= 90)
    return np.array(
        [
            np.log1p(n),
            np.log1p(chars),
            lengths.mean(),
            len(known) / n,
            (lengths <= 3).mean(),
            (lengths >= 10).mean(),
            kind["upper"] / chars,
            kind["digit"] / chars,
            counts[_SYMBOLS].sum() / chars,
            counts[ord("|")] / n,
            counts[ord("!")] / n,
            counts[ord(".")] / n,
            counts[ord(",")] / n,
            kind["high"] / chars,
            np.log1p(len(lines)),
            np.log1p(line_words.mean()),
            line_words.std() / line_words.mean(),
            1 - len(set(lines)) / len(lines),
            (windows[windows > 1].sum()) / windows.sum(),
            capital / n,
            times.max() / n,
            (kind["upper"] + kind["lower"] + kind["high"]) / chars,
        ],
        dtype=np.float64,
    )


def feature_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, x`` (the features) of every row."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in texts_of(source, "text"):
            made = pa.array([features(t) for t in texts], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), made], ["doc_id", "x"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(batches, "doc_id long, x array<double>")


# --- the model --------------------------------------------------------------------------------------


@dataclass
class Additive:
    """Bin edges and table of every feature, tables of the chosen pairs, and a constant."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 of every row: looked-up numbers added up."""
        total = np.full(len(x), self.base)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, f], side="right")]
        wide = {f: np.searchsorted(self.coarse[f], x[:, f], side="right") for pair in self.pairs for f in pair}
        for (f, g), table in zip(self.pairs, self.pair_tables):
            total += table[wide[f], wide[g]]
        return 1 / (1 + np.exp(-total))


def _bins(values: np.ndarray, most: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, most + 1)[1:-1]))


def _gain(g, h, ridge: float):
    return g * g / (h + ridge)


def _split(grad: np.ndarray, hess: np.ndarray, ridge: float, least: float) -> int:
    """Bins left of the best cut, 0 if none helps."""
    if len(grad) < 2:
        return 0
    g, h = np.cumsum(grad)[:-1], np.cumsum(hess)[:-1]
    total_g, total_h = grad.sum(), hess.sum()
    gain = _gain(g, h, ridge) + _gain(total_g - g, total_h - h, ridge) - _gain(total_g, total_h, ridge)
    gain[(h < least) | (total_h - h < least)] = 0
    k = int(np.argmax(gain))
    return k + 1 if gain[k] > 0 else 0


def _tree(grad: np.ndarray, hess: np.ndarray, depth: int, ridge: float, least: float) -> np.ndarray:
    """A shallow tree over ordered bins, as one number for each bin."""
    cut = _split(grad, hess, ridge, least) if depth else 0
    if not cut:
        return np.full(len(grad), -grad.sum() / (hess.sum() + ridge))
    return np.concatenate([_tree(grad[:cut], hess[:cut], depth - 1, ridge, least), _tree(grad[cut:], hess[cut:], depth - 1, ridge, least)])


def _pair_tree(grad: np.ndarray, hess: np.ndarray, ridge: float, least: float) -> np.ndarray:
    """One cut of the first feature, then one of the second on either side; or the other way round, if that gains more."""
    best, best_gain = None, 0.0
    for turned in (False, True):
        g, h = (grad.T, hess.T) if turned else (grad, hess)
        cut = _split(g.sum(1), h.sum(1), ridge, least)
        cut = cut or max(1, len(g) // 2)
        made = np.empty_like(g)
        gained = 0.0
        for part in (slice(0, cut), slice(cut, len(g))):
            pg, ph = g[part].sum(0), h[part].sum(0)
            column = _tree(pg, ph, 1, ridge, least)
            made[part] = column[None, :]
            gained -= float((pg * column + 0.5 * ph * column**2).sum())
        if gained > best_gain:
            best, best_gain = (made.T if turned else made), gained
    return np.zeros_like(grad) if best is None else best


def fit(x: np.ndarray, y: np.ndarray, bins: int = 48, coarse: int = 8, cycles: int = 120, pairs: int = 6, pair_cycles: int = 40, rate: float = 0.15, ridge: float = 2.0, least: float = 3.0) -> Additive:
    """Cyclic boosting on the logistic loss. Without rows, or with one label only, the score is a constant."""
    width = x.shape[1] if x.ndim == 2 else len(FEATURES)
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Additive(base, [np.zeros(0)] * width, [np.zeros(1)] * width, [], [np.zeros(0)] * width, [])
    edges = [_bins(x[:, f], bins) for f in range(width)]
    at = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(cycles):
        for f in range(width):
            g, h = slopes()
            step = rate * _tree(np.bincount(at[f], g, len(tables[f])), np.bincount(at[f], h, len(tables[f])), 2, ridge, least)
            tables[f] += step
            total += step[at[f]]

    rough = [_bins(x[:, f], coarse) for f in range(width)]
    wide = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(rough)]

    def grid(f: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(rough[f]) + 1, len(rough[k]) + 1)
        g, h = slopes()
        cell = wide[f] * shape[1] + wide[k]
        return np.bincount(cell, g, shape[0] * shape[1]).reshape(shape), np.bincount(cell, h, shape[0] * shape[1]).reshape(shape)

    def explained(f: int, k: int) -> float:
        g, h = grid(f, k)
        return float(_gain(g, h, ridge).sum() - _gain(g.sum(1), h.sum(1), ridge).sum() - _gain(g.sum(0), h.sum(0), ridge).sum())

    ranked = sorted(((explained(f, k), f, k) for f in range(width) for k in range(f + 1, width)), reverse=True)
    chosen = [(f, k) for gain, f, k in ranked[:pairs] if gain > 0]
    pair_tables = [np.zeros((len(rough[f]) + 1, len(rough[k]) + 1)) for f, k in chosen]
    for _ in range(pair_cycles):
        for number, (f, k) in enumerate(chosen):
            step = rate * _pair_tree(*grid(f, k), ridge, least)
            pair_tables[number] += step
            total += step[wide[f], wide[k]]
    return Additive(base, edges, tables, chosen, rough, pair_tables)


def learn(rows: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = 20_000) -> Additive:
    """Fit on labelled rows that are not held out: at most ``most_rows`` different ones, of the ids with the smallest hashes.

    Rows without id or label teach nothing; of several labels of an id the largest counts.
    """
    marked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col(label).cast("double")).alias("y"))
    known = marked.join(rows.select(F.col("doc_id").alias("_id")).distinct(), F.col("id") == F.col("_id"), "left_semi")
    picked = F.broadcast(smallest_hashes(known, most_rows, F.xxhash64("id"), "id"))  # most_rows rows of two numbers
    found = rows.join(picked, F.col("doc_id") == F.col("id")).select("id", "x", "y").distinct()
    sample = smallest_hashes(found, most_rows, F.xxhash64("id", "x"), "id", "x").select("x", "y").collect()
    return fit(np.array([r["x"] for r in sample]).reshape(len(sample), len(FEATURES)), np.array([r["y"] for r in sample]))


def quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3, most_rows: int = 20_000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``, from its text alone.

    Null and empty texts have all features zero and the score the tables give for that. Repeated rows get the same score.
    """
    rows = staged(feature_rows(docs, doc_id, text), "features")
    model = learn(rows, labels, most_rows=most_rows)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(x))], ["doc_id", "score"])

    scored = rows.mapInArrow(batches, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
