"""Toxic documents by a convolutional classifier over hashed words.

Filters of several widths run over the embeddings of a whole text; of each filter only the
strongest answer counts. A bounded sample gives the network its start; then it learns from
every labelled text that is not held out: tasks go on from the start on their share of the
texts, and what they have learned is averaged, each word's vector over the texts that hold
the word. A score takes nothing but the text; the threshold that flags a document is
calibrated for its language on all labelled texts kept from training.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import held_out, smallest_hashes, staged

TOKEN = re.compile(r"\w+")
BUCKETS = 1 << 17
#: A word's vector is the sum of those of the whole word, its beginning and its end.
PIECES = 3
#: Bucket of what has no vector: the padding around a text, and pieces that few texts have.
SILENT = BUCKETS
#: Words taken through the filters at once.
BLOCK = 1 << 15
#: Texts of one training step.
BATCH = 32
#: A bucket that fewer texts have stays silent: it could only be learned by heart.
LEAST_TEXTS = 4
#: Labelled ids from which on a sixth is kept from training.
LEAST_LABELS = 60
#: Labelled texts that one task learns from, about.
SHARE = 20_000
#: Numbers that are sent to the tasks at most.
SENT = 1 << 20
#: A threshold is drawn to its prior as by so many positives.
WEIGHT = 5.0


def pieces(word: str) -> tuple[int, int, int]:
    """Hash buckets of a word, of its first five and its last three characters."""
    return tuple(zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in (f"<{word}>", f"<{word[:5]}", f"{word[-3:]}>"))


class Words(dict):
    """Numbers for words as they are met, with the buckets of each; emptied when it has grown large."""

    def __init__(self):
        super().__init__()
        self.rows: list[tuple[int, int, int]] = []

    def __missing__(self, word: str) -> int:
        self.rows.append(pieces(word))
        number = self[word] = len(self.rows) - 1
        return number

    def numbers(self, text: str) -> np.ndarray:
        if len(self.rows) > 200_000:
            self.clear()
            self.rows.clear()
        words = TOKEN.findall(text.lower())
        return np.fromiter(map(self.__getitem__, words), dtype=np.int32, count=len(words))

    def codes(self, text: str) -> np.ndarray:
        """One row of buckets for each word of the text."""
        numbers = self.numbers(text)
        if not len(numbers):
            return np.zeros((0, PIECES), np.int32)
        known, back = np.unique(numbers, return_inverse=True)
        return np.array([self.rows[k] for k in known], dtype=np.int32)[back]


@dataclass
class Network:
    """Embeddings, one weight block and bias per filter width, and the output layer; ``past`` are the sums of squared slopes."""

    embed: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    base: float
    past: list[np.ndarray] | None = None

    @staticmethod
    def fresh(rng: np.random.Generator, widths: tuple[int, ...], size: int, count: int) -> Network:
        embed = rng.normal(0, 0.1, (BUCKETS + 1, size)).astype(np.float32)
        embed[SILENT] = 0
        filters = [rng.normal(0, 0.5 / np.sqrt(k), (k, size, count)).astype(np.float32) for k in widths]
        return Network(embed, filters, [np.zeros(count, np.float32) for _ in widths], rng.normal(0, 0.3, count * len(widths)).astype(np.float32), -1.0)

    @property
    def edge(self) -> int:
        return max(len(f) for f in self.filters)

    def pooled(self, numbers: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """The strongest answer of every filter over the whole text, a block of words at a time.

        ``vectors`` has a row for every word number; the text is padded with silence.
        """
        around = np.zeros((self.edge, vectors.shape[1]), np.float32)
        best = [np.full(f.shape[2], -np.inf, np.float32) for f in self.filters]
        for start in range(0, len(numbers) + 1, BLOCK):
            end = start + BLOCK + self.edge
            inside = vectors[numbers[max(0, start - self.edge) : end]]
            ahead = [] if start else [around]
            behind = [around] if end >= len(numbers) else []
            x = np.concatenate([*ahead, inside, *behind])
            for k, (f, b) in enumerate(zip(self.filters, self.biases)):
                n = len(x) - len(f) + 1
                answers = sum(x[j : j + n] @ f[j] for j in range(len(f)))
                best[k] = np.maximum(best[k], answers.max(axis=0) + b)
        return np.maximum(np.concatenate(best), 0)

    def score(self, numbers: np.ndarray, vectors: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-(self.pooled(numbers, vectors) @ self.out + self.base))))

    def composed(self, codes: np.ndarray) -> np.ndarray:
        return self.embed[codes].sum(axis=1)

    def dense(self) -> np.ndarray:
        """All numbers but the embeddings, in rows as wide as an embedding."""
        flat = np.concatenate([p.ravel() for p in (*self.filters, *self.biases, self.out)] + [[self.base]])
        return np.concatenate([flat, np.zeros(-len(flat) % self.embed.shape[1])]).reshape(-1, self.embed.shape[1])

    def filled(self, embed: np.ndarray, dense: np.ndarray) -> Network:
        """A network of this shape with the numbers of ``dense``."""
        flat, parts, at = dense.ravel(), [], 0
        for p in (*self.filters, *self.biases, self.out):
            parts.append(flat[at : at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        k = len(self.filters)
        return Network(embed, parts[:k], parts[k : 2 * k], parts[-1], float(flat[at]))

    def score_codes(self, codes: np.ndarray) -> float:
        return self.score(np.arange(len(codes)), self.composed(codes))


class Scorer:
    """Scores texts one after the other, composing the vector of a word once."""

    def __init__(self, net: Network):
        self.net, self.words = net, Words()
        self.vectors = np.zeros((0, net.embed.shape[1]), np.float32)
        self.made = 0

    def __call__(self, text: str) -> float:
        numbers = self.words.numbers(text)
        have = len(self.words.rows)
        if have < self.made or not have:
            self.made = 0
        if have > len(self.vectors):
            grown = np.zeros((max(1024, 2 * have), self.vectors.shape[1]), np.float32)
            grown[: self.made] = self.vectors[: self.made]
            self.vectors = grown
        if have > self.made:
            self.vectors[self.made : have] = self.net.composed(np.array(self.words.rows[self.made : have], dtype=np.int32))
            self.made = have
        return self.net.score(numbers, self.vectors)


class Training:
    """AdaGrad on the cross entropy, with words left out at random; goes on from the network's sums of squared slopes."""

    def __init__(self, net: Network, rng: np.random.Generator, rate: float = 0.05, drop: float = 0.2):
        self.net, self.rng, self.rate, self.drop = net, rng, rate, drop
        if net.past is None:
            net.past = [np.full(np.shape(p), 1e-4, np.float32) for p in (net.embed, net.out, *net.filters, *net.biases)] + [np.float64(1e-4)]

    def padded(self, codes: np.ndarray, silent: np.ndarray | None = None) -> np.ndarray:
        around = np.full((self.net.edge, PIECES), SILENT, dtype=np.int32)
        return np.concatenate([around, codes if silent is None else np.where(silent[codes], SILENT, codes), around])

    def step(self, rows: list[np.ndarray], y: np.ndarray) -> None:
        """One step on padded texts."""
        net, rate, past = self.net, self.rate, self.net.past
        widths, size, count = len(net.filters), net.embed.shape[1], net.filters[0].shape[2]
        past_filters, past_biases = slice(2, 2 + widths), slice(2 + widths, 2 + 2 * widths)
        words = np.concatenate(rows)
        words[self.rng.random(len(words)) < self.drop] = SILENT
        ends = np.cumsum([len(r) for r in rows])
        begins = np.concatenate([[0], ends[:-1]])
        vectors = net.composed(words)
        pooled, at = np.empty((len(rows), count * widths), np.float32), []
        for w, (f, b) in enumerate(zip(net.filters, net.biases)):
            n = len(vectors) - len(f) + 1
            answers = sum(vectors[j : j + n] @ f[j] for j in range(len(f)))
            places = np.array([s + answers[s : e - len(f) + 1].argmax(axis=0) for s, e in zip(begins, ends)])
            pooled[:, w * count : (w + 1) * count] = answers[places, np.arange(count)] + b
            at.append(places)
        active = pooled > 0
        answer = np.where(active, pooled, 0)
        error = (1 / (1 + np.exp(-(answer @ net.out + net.base))) - y).astype(np.float32) / len(rows)
        spread = error[:, None] * net.out[None, :] * active
        g_out, g_base = answer.T @ error, float(error.sum())
        where, slopes = [], []
        for w, f in enumerate(net.filters):
            part = spread[:, w * count : (w + 1) * count]
            g_f = np.empty_like(f)
            for j in range(len(f)):
                picked = at[w] + j
                g_f[j] = np.einsum("nf,nfs->sf", part, vectors[picked])
                own = (part[:, :, None] * f[j].T[None]).reshape(-1, size)
                for piece in range(PIECES):
                    where.append(words[picked, piece].ravel())
                    slopes.append(own)
            g_b = part.sum(axis=0)
            past[past_filters][w][...] += g_f**2
            past[past_biases][w][...] += g_b**2
            net.filters[w] = f - rate * g_f / np.sqrt(past[past_filters][w])
            net.biases[w] = net.biases[w] - rate * g_b / np.sqrt(past[past_biases][w])
        touched, back = np.unique(np.concatenate(where), return_inverse=True)
        g_e = np.zeros((len(touched), size), np.float32)
        np.add.at(g_e, back, np.concatenate(slopes))
        g_e[touched == SILENT] = 0
        past[0][touched] += g_e**2
        net.embed[touched] -= rate * g_e / np.sqrt(past[0][touched])
        past[1] += g_out**2
        past[-1] += g_base**2
        net.out = net.out - rate * g_out / np.sqrt(past[1])
        net.base -= rate * g_base / np.sqrt(past[-1])


def constant(net: Network, found: float, of: int) -> Network:
    """The network with one score for all texts."""
    share = (found + 1) / (of + 2)
    net.out[:], net.base = 0, float(np.log(share / (1 - share)))
    return net


def fit(
    texts: list[np.ndarray], y: np.ndarray, widths: tuple[int, ...] = (1, 2, 3), size: int = 8, count: int = 6, rounds: int = 10, batch: int = BATCH, rate: float = 0.05, least_texts: int = LEAST_TEXTS, drop: float = 0.2, seed: int = 5
) -> Network:
    """A network trained on texts in memory, in several rounds.

    Buckets in fewer than ``least_texts`` of the texts stay silent. Without texts, or with one label only, the score
    is a constant.
    """
    rng = np.random.default_rng(seed)
    net = Network.fresh(rng, widths, size, count)
    if len(texts) == 0 or y.min() == y.max():
        return constant(net, y.sum(), len(y))
    holders = np.zeros(BUCKETS + 1, dtype=np.int64)
    for t in texts:
        holders[np.unique(t)] += 1
    silent = holders < least_texts
    silent[SILENT] = True
    net.embed[silent] = 0
    training = Training(net, rng, rate, drop)
    rows = [training.padded(t, silent) for t in texts]
    for _ in range(rounds):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), batch):
            now = order[start : start + batch]
            training.step([rows[k] for k in now], y[now])
    return net


def best_threshold(scores: np.ndarray, y: np.ndarray, prior: float = 0.5, weight: float = WEIGHT) -> float:
    """The threshold with the highest F1, halfway in a gap between scores, drawn to ``prior`` by few positives.

    For numbers in memory; ``best_cuts`` takes those of a table.
    """
    found = int(y.sum())
    if not found:
        return prior
    order = np.argsort(-scores, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + found)
    k = int(np.argmax(f1))
    below = scores[order[k + 1]] if k + 1 < len(order) else 0.0
    cut = float(scores[order[k]] + below) / 2
    return (found * cut + weight * prior) / (found + weight)


def best_cuts(rows: DataFrame) -> DataFrame:
    """``lang, cut, found`` from ``lang, score, y``: the cut with the highest F1 of every language, and of all rows (lang
    null), halfway to the next score below, and the number of positives.

    Rows are counted by score, scores by narrow bins of the log odds; running sums over the bins carry into each bin, so no
    task holds a language.
    """
    each = rows.select(F.explode(F.array_distinct(F.array(F.lit(None).cast("string"), "lang"))).alias("lang"), "score", "y")
    odds = F.ln(F.col("score") + 1e-300) - F.ln(1 - F.col("score") + 1e-17)
    each = each.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("hits")).withColumn("bin", F.floor(64 * odds))
    down = Window.partitionBy("lang").orderBy(F.col("bin").desc())
    above, whole = down.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("lang")
    bins = each.groupBy("lang", "bin").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.max("score").alias("top"))
    bins = bins.select(
        F.col("lang").alias("_lang"),
        F.col("bin").alias("_bin"),
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
        F.coalesce(F.sum("hits").over(above), F.lit(0)).alias("hits_above"),
        F.coalesce(F.lead("top").over(down), F.lit(0.0)).alias("under"),
        F.sum("hits").over(whole).alias("found"),
    )
    inside = Window.partitionBy("lang", "bin").orderBy(F.col("score").desc())
    until = inside.rowsBetween(Window.unboundedPreceding, 0)
    ranked = each.join(bins, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("bin") == F.col("_bin")))
    ranked = ranked.select("lang", "score", "found", F.coalesce(F.lead("score").over(inside), "under").alias("below"), (F.col("n_above") + F.sum("n").over(until)).alias("rank"), (F.col("hits_above") + F.sum("hits").over(until)).alias("hits"))
    best = F.max(F.struct((2 * F.col("hits") / (F.col("rank") + F.col("found"))).alias("f1"), "score", "below", "found")).alias("best")
    return ranked.groupBy("lang").agg(best).select("lang", ((F.col("best.score") + F.col("best.below")) / 2).alias("cut"), F.col("best.found").alias("found"))


def kept_back(doc_id: Column) -> Column:
    """A sixth of the ids, by their CRC-32: labelled, but not trained on."""
    return F.crc32(F.concat(F.lit("spare "), doc_id.cast("string")).cast("binary")) % 6 == 0


def _rows(docs: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    own = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), own.alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"), F.xxhash64(own).alias("body"))


def known_labels(docs: DataFrame, labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """``id, y, spare`` of the labelled ids that are not held out and stand in ``docs``; ``spare`` ones calibrate thresholds."""
    marked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marked = marked.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    ids = docs.select(F.col(f"`{doc_id}`").cast("long").alias("_id")).distinct()
    known = staged(marked.join(ids, F.col("id") == F.col("_id"), "left_semi"), "known")
    return known.withColumn("spare", kept_back(F.col("id")) if known.count() >= LEAST_LABELS else F.lit(False))


def refined(start: Network, texts: DataFrame, tasks: int, least_texts: int = LEAST_TEXTS) -> Network:
    """The network after all ``texts`` (``id, body, text, y``): every task goes on from ``start`` on its share of them,
    repeated rows left out, and the numbers are averaged, weighted by texts, those of a bucket by texts that hold it.

    At most ``BUCKETS`` and some rows of sums reach the driver, whatever the number of texts.
    """

    def learned(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = start.filled(start.embed.copy(), start.dense())
        net.past = None if start.past is None else [np.array(p) for p in start.past]
        training = Training(net, np.random.default_rng([5, TaskContext.get().partitionId()]))
        words, holders, last, seen = Words(), np.zeros(BUCKETS + 1, dtype=np.int64), None, 0
        rows, y = [], []
        for batch in source:
            for row_id, body, text, label in zip(*(batch.column(c).to_pylist() for c in ("id", "body", "text", "y"))):
                if (row_id, body) == last:
                    continue
                last, seen = (row_id, body), seen + 1
                codes = words.codes(text)
                holders[np.unique(codes)] += 1
                rows.append(training.padded(codes))
                y.append(label)
                if len(rows) == BATCH:
                    training.step(rows, np.array(y, dtype=np.float32))
                    rows, y = [], []
        if rows:
            training.step(rows, np.array(y, dtype=np.float32))
        if seen:
            dense, met = net.dense(), np.flatnonzero(holders)
            places = np.concatenate([met, np.arange(len(dense)) + BUCKETS + 1])
            held = np.concatenate([holders[met], np.full(len(dense), seen)])
            values = np.concatenate([net.embed[met].astype(np.float64), dense])
            for at in range(0, len(places), 10_000):
                part = slice(at, at + 10_000)
                yield pa.RecordBatch.from_arrays([pa.array(places[part]), pa.array(held[part]), pa.array(list(values[part]), pa.list_(pa.float64()))], ["place", "held", "values"])

    order = F.xxhash64("id", "body")
    dealt = texts.repartition(tasks, "id", "body").sortWithinPartitions(order, "id", "body")
    told = dealt.select("id", "body", "text", "y").mapInArrow(learned, "place long, held long, values array<double>")
    size = start.embed.shape[1]
    sums = told.groupBy("place").agg(F.sum("held").alias("held"), *(F.sum(F.col("held") * F.get("values", F.lit(k))).alias(f"v{k}") for k in range(size))).toArrow()
    place, held = sums["place"].to_numpy(), sums["held"].to_numpy()
    means = np.stack([sums[f"v{k}"].to_numpy() for k in range(size)], axis=1) / held[:, None]
    embed, dense = np.zeros_like(start.embed), start.dense()
    known = (place < BUCKETS) & (held >= least_texts)
    embed[place[known]] = means[known]
    rest = place > BUCKETS
    dense[place[rest] - BUCKETS - 1] = means[rest]
    return start.filled(embed, dense)


def learn(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, lang: str, label: str = "toxic", most_rows: int = 8000, most_bytes: int = 1 << 26, known: DataFrame | None = None) -> Network:
    """A network that has learned from all labelled rows that are not held out and not kept back for the thresholds.

    It starts from a sample in memory: of the ids with the smallest hashes, at most ``most_rows`` different whole
    texts, of at most ``most_bytes`` together. If there are more labelled texts, ``refined`` takes them all.
    """
    known = known_labels(docs, labels, doc_id, label) if known is None else known
    total, trained, found = known.agg(F.count(F.lit(1)), F.count_if(~F.col("spare")), F.coalesce(F.sum(F.when(~F.col("spare"), F.col("y"))), F.lit(0))).first()
    rows = _rows(docs, doc_id, text, lang)
    ids = F.broadcast(smallest_hashes(known, most_rows, F.xxhash64("id"), "id"))  # most_rows rows of two numbers and a mark
    texts = staged(rows.join(ids, F.col("doc_id") == F.col("id")).select("id", "body", "y", F.octet_length("text").alias("size")).distinct(), "texts")
    picks = smallest_hashes(texts, most_rows + 1, F.xxhash64("id"), "id", "body").collect()
    kept, left = [], most_bytes
    for row in picks[:most_rows]:
        if row["size"] <= left:
            kept.append((row["id"], row["body"], row["y"]))
            left -= row["size"]
    whole = total <= most_rows and len(kept) == len(picks)
    picked = F.broadcast(docs.sparkSession.createDataFrame(kept, "_id long, _body long, y int"))
    sample = rows.join(picked, (F.col("doc_id") == F.col("_id")) & (F.col("body") == F.col("_body")))
    sample = sample.select(F.col("doc_id").alias("id"), "text", "lang", "y", (kept_back(F.col("doc_id")) & F.lit(total >= LEAST_LABELS)).alias("spare")).distinct().where("NOT spare")

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in source:
            codes = [words.codes(t or "").ravel() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(codes, pa.list_(pa.int32())), batch.column("y")], ["id", "codes", "y"])

    got = sample.select("id", "text", "y").mapInArrow(batches, "id long, codes array<int>, y int").toArrow()
    rows_of = sorted(zip(got["id"].to_pylist(), (c.values.to_numpy().reshape(-1, PIECES) for c in got["codes"]), got["y"].to_pylist()), key=lambda r: (r[0], len(r[1]), r[1].tobytes()))
    y = np.array([r[2] for r in rows_of], dtype=np.float32)
    net = fit([r[1] for r in rows_of], y)
    if whole:
        return net
    if found in (0, trained):
        return constant(net, found, trained)
    if len(y) == 0 or y.min() == y.max():  # the sample missed a label that the whole table has
        net = Network.fresh(np.random.default_rng(5), tuple(map(len, net.filters)), net.embed.shape[1], net.filters[0].shape[2])
        net.base = float(np.log(found / (trained - found)))
    marks = known.where("NOT spare").select("id", "y")
    marks = F.broadcast(marks) if trained <= SENT else marks
    mine = rows.select(F.col("doc_id").alias("_id"), "text", "body").join(marks, F.col("_id") == F.col("id"))
    return refined(net, mine, 1 + trained // SHARE)


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", threshold: float = 0.5, most_rows: int = 8000) -> DataFrame:
    """``doc_id, held_out, score, predicted, lang_threshold, flagged`` of every row of ``docs``.

    ``predicted`` compares the score with ``threshold``, ``flagged`` with the threshold calibrated for the row's
    language; a null or unknown language has the overall one. Null and empty texts have the score of silent filters.
    Repeated rows get the same score each; no rows give an empty result.
    """
    known = known_labels(docs, labels, doc_id, "toxic")
    net = learn(docs, labels, doc_id, text, lang, most_rows=most_rows, known=known)
    net.past = None

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(net)
        for batch in source:
            scores = pa.array([score(t) for t in batch.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("body"), batch.column("lang"), scores], ["doc_id", "body", "lang", "score"])

    scored = staged(_rows(docs, doc_id, text, lang).mapInArrow(batches, "doc_id long, body long, lang string, score double"), "scored")
    spare = scored.join(known.where("spare").select("id", "y"), F.col("doc_id") == F.col("id")).select("doc_id", "body", "lang", "score", "y").distinct()
    cuts = staged(best_cuts(spare.select("lang", "score", "y")), "cuts")
    drawn = lambda prior: (F.col("found") * F.col("cut") + WEIGHT * prior) / (F.col("found") + WEIGHT)
    overall = cuts.where("lang IS NULL").select(drawn(0.5)).first()
    overall = overall[0] if overall else 0.5
    limits = cuts.where("lang IS NOT NULL").select(F.col("lang").alias("_lang"), drawn(overall).alias("_limit"))
    limits = F.broadcast(limits) if limits.count() <= SENT else limits
    joined = scored.join(limits, F.col("lang") == F.col("_lang"), "left").withColumn("lang_threshold", F.coalesce("_limit", F.lit(overall)))
    return joined.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "lang_threshold",
        (F.col("score") >= F.col("lang_threshold")).alias("flagged"),
    )
