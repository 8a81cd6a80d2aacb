"""Token sequences of a fixed length, filled with as many whole documents as fit.

Documents become token ids; those longer than a sequence are cut. The pieces are dealt to shards. A shard is packed by
bin completion: take the largest piece left, enumerate the fillings of the space beside it that no other filling
dominates, go on with the least waste, and turn back where the waste spent leaves no room for a better packing than
the best one known. Best-fit packings, of the whole shard at first and of what is left later, are the incumbents.
Sequences that stay too empty go through another, smaller round, so that shards cost nothing.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import staged

# --- tokens -------------------------------------------------------------------------------------------

#: How byte-level encoders split a text into words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters beyond these may be classed in another way by another Unicode version, and very long words take long to merge.
UNUSUAL = re.compile("[^\x00-\x1b\x20-ɏ‐-‧‰-⁞、-〩ぁ-ゖ一-龥]|\\S{300}|\\s{300}")
#: Characters encoded at once.
BLOCK = 1 << 22


def _byte_signs() -> dict[str, int]:
    """The sign that byte-level vocabularies write for each byte: itself if printable, else one of those from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Token ids of a tokenizer file, as little-endian bytes.

    Where the vocabulary is byte-level and its numbers follow its merges, usual texts go through a merger that needs the
    ranks alone and is several times as fast; it makes the same ids. All other texts go through the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.added = [t["content"] for t in settings.get("added_tokens") or []]
        self.merger = self._merger(settings)

    def _merger(self, settings: dict):
        split, model = settings.get("pre_tokenizer") or {}, settings["model"]
        plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        odd = any(settings.get(k) for k in ("normalizer", "truncation", "padding")) or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if not plain or odd or model.get("type", "BPE") != "BPE":
            return None
        vocabulary, signs = model["vocab"], _byte_signs()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = [vocabulary.get(a + b, -1) for a, b in merges]
        single = [vocabulary.get(s, -1) for s in signs]
        if min(single) < 0 or made != sorted(set(made)) or made and made[0] <= max(single):
            return None
        import tiktoken

        ranks = {bytes(signs[s] for s in token): vocabulary[token] for token in [*signs, *("".join(m) for m in merges)]}
        return tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        usual = [self.merger is not None and not UNUSUAL.search(t) and not any(a in t for a in self.added) for t in texts]
        whole = self.tokenizer.encode_batch_fast([t for t, u in zip(texts, usual) if not u], add_special_tokens=False)
        others = iter([e.ids for e in whole])
        return [np.array(self.merger.encode_ordinary(t) if u else next(others), dtype="<u4").tobytes() for t, u in zip(texts, usual)]


@functools.cache
def encoder(path: str) -> Encoder:
    """One for each worker."""
    return Encoder(path)


def cut(length: int, most: int) -> Iterator[tuple[int, int]]:
    """Start and length of the pieces; only the first one may be shorter than ``most``."""
    first = (length - 1) % most + 1
    yield 0, first
    for start in range(first, length, most):
        yield start, most


def pieces(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", most: int = 2048, end: int = 0, with_ids: bool = False) -> DataFrame:
    """``uid, doc_id, piece, start, length, ids_crc32`` of every piece, stored; with ``ids`` (little-endian bytes) if asked.

    A document is the token ids of its whole text (a null text is empty), then the id ``end``.
    """

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        last = struct.pack("<I", end)
        for batch in source:
            texts, at = [t or "" for t in batch.column("text").to_pylist()], 0
            while at < len(texts):
                stop, held = at, 0
                while stop < len(texts) and (held == 0 or held + len(texts[stop]) <= BLOCK):
                    held, stop = held + len(texts[stop]) + 1, stop + 1
                rows = []
                for k, ids in enumerate(own.encode(texts[at:stop]), at):
                    ids += last
                    for number, (start, length) in enumerate(cut(len(ids) // 4, most)):
                        part = ids[4 * start : 4 * (start + length)]
                        rows.append((k, number, start, length, zlib.crc32(part), part if with_ids else None))
                columns = list(zip(*rows))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                made = [pa.array(c, t) for c, t in zip(columns[1:], kinds)][: 4 + with_ids]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(columns[0])), *made], names)
                at = stop

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    made = rows.mapInArrow(batches, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)
    return staged(made.withColumn("uid", F.monotonically_increasing_id()), "pieces")


# --- one shard ----------------------------------------------------------------------------------------


def best_fit(lengths: list[int], most: int) -> list[list[int]]:
    """Bins by best fit, the longest first: a piece goes where it leaves the least space."""
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(most + 1)]
    spaces = 0
    for length in sorted(lengths, reverse=True):
        fits = spaces >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            at = by_free[free].pop()
            if not by_free[free]:
                spaces ^= 1 << free
        else:
            free, at = most, len(bins)
            bins.append([])
        bins[at].append(length)
        by_free[free - length].append(at)
        spaces |= 1 << (free - length)
    return bins


def lower_bound(lengths: list[int], most: int) -> int:
    """Bins that any packing needs: by volume, and by pieces of which no two share a bin."""
    held = np.bincount(lengths, minlength=most + 1)
    count, volume = np.cumsum(held), np.cumsum(held * np.arange(most + 1))
    middle = most // 2
    small = np.arange(1, middle + 1)
    alone = len(lengths) - count[most - small]
    halves, half_volume = count[most - small] - count[middle], volume[most - small] - volume[middle]
    over = volume[middle] - volume[small - 1] - (halves * most - half_volume)
    pairs = alone + halves + np.maximum(0, -(-over // most))
    return max(-(-int(volume[-1]) // most), int(pairs.max(initial=0)))


def _smeared(bits: int, most: int) -> int:
    """The set of bits moved up by 0 to ``most`` places."""
    width = 0
    while width < most:
        step = min(width + 1, most - width)
        bits, width = bits | bits << step, width + step
    return bits


class Shard:
    """Pieces left, as counts by length and as sets of bits: bit x, and bit ``most`` - x, for a length x that is left."""

    def __init__(self, lengths: list[int], most: int):
        self.most, self.counts = most, Counter(lengths)
        self.left = sum(1 << x for x in self.counts)
        self.turned = sum(1 << (most - x) for x in self.counts)

    def take(self, length: int) -> None:
        self.counts[length] -= 1
        if not self.counts[length]:
            del self.counts[length]
            self.left ^= 1 << length
            self.turned ^= 1 << (self.most - length)

    def give(self, length: int) -> None:
        self.counts[length] += 1
        self.left |= 1 << length
        self.turned |= 1 << (self.most - length)

    def subsets(self, total: int, top: int, k: int, steps: list[int]) -> Iterator[tuple[int, ...]]:
        """``k`` lengths up to ``top``, the longest first, that add up to ``total``; ``steps`` counts down the lengths tried."""
        if k == 1:
            if 0 < total <= top and self.counts.get(total):
                yield (total,)
            return
        if k == 2:
            pairs = self.left & (self.turned >> (self.most - total)) & ((1 << (min(top, total - 1) + 1)) - 1)
            pairs >>= (total + 1) // 2
            while pairs:
                a = (total + 1) // 2 + pairs.bit_length() - 1
                pairs ^= 1 << (pairs.bit_length() - 1)
                if a != total - a or self.counts[a] > 1:
                    yield (a, total - a)
            return
        tried = self.left & ((1 << (min(top, total - k + 1) + 1)) - 1)
        while tried and steps[0] > 0:
            a = tried.bit_length() - 1
            if a * k < total:
                return
            tried ^= 1 << a
            steps[0] -= 1
            rest = self.subsets(total - a, a, k - 1, steps)
            while True:  # the length is taken only while the others are looked for
                self.take(a)
                found = next(rest, None)
                self.give(a)
                if found is None:
                    break
                yield (a, *found)

    def dominated(self, filling: tuple[int, ...], waste: int) -> bool:
        """Whether a length that is left can stand for some of the filling, or be added, within the waste: then that is no worse."""
        one, many = 1, 0
        for x in filling:
            many |= (one & ~1 | many) << x
            one |= 1 << x
        left = self.left
        for x, n in Counter(filling).items():
            if self.counts[x] <= n:
                left &= ~(1 << x)
        longer = _smeared(one << 1, waste - 1) if waste else 0
        return bool(left & (longer | _smeared(many, waste)))

    def fillings(self, room: int, most_waste: int, tries: int) -> Iterator[tuple[tuple[int, ...], int]]:
        """Undominated fillings of ``room`` and their waste, the least waste and fewest pieces first; at last the best-fit filling."""
        smallest = (self.left & -self.left).bit_length() - 1
        if not self.left or smallest > room:
            yield (), room
            return
        steps, taken = [tries], self._best_fit(room)
        for more in (range(3), None):  # first with about as few pieces as can be
            for waste in range(min(room - smallest, most_waste) + 1):
                top = (self.left & ((1 << (room - waste + 1)) - 1)).bit_length() - 1
                least = -(-(room - waste) // top)
                for k in range(least, least + 3) if more else range(least + 3, (room - waste) // smallest + 1):
                    for found in self.subsets(room - waste, top, k, steps):
                        steps[0] -= 1
                        if found != taken and not self.dominated(found, waste):
                            yield found, waste
                            if k == 1 and waste == 0:
                                return  # a single piece that fits dominates everything
                        if steps[0] <= 0:
                            break
                    if steps[0] <= 0:
                        break
                if steps[0] <= 0:
                    break
        if taken and room - sum(taken) <= most_waste:
            yield taken, room - sum(taken)

    def _best_fit(self, room: int) -> tuple[int, ...]:
        """The longest pieces that fit, one after the other."""
        taken: list[int] = []
        while below := self.left & ((1 << (room + 1)) - 1):
            taken.append(below.bit_length() - 1)
            room -= taken[-1]
            self.take(taken[-1])
        for x in taken:
            self.give(x)
        return tuple(taken)


def pack_shard(lengths: list[int], most: int, nodes: int = 20_000, tries: int = 64) -> list[list[int]]:
    """Bins of at most ``most`` in all, as few as the search finds: branch and bound over fillings beside the longest piece.

    ``nodes`` fillings are tried at most, and ``tries`` lengths in looking for the fillings of one bin; a search that is cut
    off returns the best packing met.
    """
    best = best_fit(lengths, most)
    least = lower_bound(lengths, most)
    if len(best) <= least:
        return best
    shard, total = Shard(lengths, most), sum(lengths)
    chosen: list[tuple[int, ...]] = []
    wasted = [0]

    def spare() -> int:
        """Waste that a better packing could still have."""
        return (len(best) - 1) * most - total - wasted[-1]

    def options() -> Iterator[tuple[tuple[int, ...], int]]:
        first = shard.left.bit_length() - 1
        found = shard.fillings(most - first, spare(), tries)
        while True:
            shard.take(first)
            option = next(found, None)
            shard.give(first)
            if option is None:
                return
            yield (first, *option[0]), option[1]

    stack = [options()]
    while stack and nodes > 0 and len(best) > least:
        option = next(stack[-1], None) if spare() >= 0 else None
        if option is None:
            stack.pop()
            if chosen:
                wasted.pop()
                for x in chosen.pop():
                    shard.give(x)
            continue
        if option[1] > spare():
            continue
        nodes -= 1
        for x in option[0]:
            shard.take(x)
        chosen.append(option[0])
        wasted.append(wasted[-1] + option[1])
        if not shard.left or len(chosen) % 128 == 0:
            rest = best_fit(list(shard.counts.elements()), most)
            if len(chosen) + len(rest) < len(best):
                best = [list(c) for c in chosen] + rest
        stack.append(options() if shard.left else iter(()))
    return best


# --- all shards ---------------------------------------------------------------------------------------


def _solver(most: int, nodes: int, last: int):
    """Per shard: ``uid, length, bin, offset, open`` of its pieces; bins with more than ``last`` left over are open."""

    def solve(rows: pa.Table) -> pa.Table:
        uid, length = rows["uid"].to_numpy(), rows["length"].to_numpy()
        by_length: dict[int, list[int]] = {}
        for u, n in zip(uid[np.argsort(-uid)].tolist(), length[np.argsort(-uid)].tolist()):
            by_length.setdefault(n, []).append(u)
        out = []
        for number, filled in enumerate(pack_shard(length.tolist(), most, nodes)):
            at, left = 0, most - sum(filled)
            for n in filled:
                out.append((by_length[n].pop(), n, number, at, left > last))
                at += n
        columns = [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()])]
        return pa.table([pa.array([rows["shard"][0].as_py()] * len(out), pa.int64()), *columns], names=["shard", "uid", "length", "bin", "offset", "open"])

    return solve


def packed(stored: DataFrame, most: int = 2048, shard: int = 8192, nodes: int = 20_000) -> DataFrame:
    """``uid, sequence_id, offset`` of stored pieces (``uid, length``), each length 1 to ``most``.

    Pieces are dealt to shards of about ``shard`` pieces by a hash of ``uid``, which differs in every row, so that no length or
    document makes a shard larger. Sequences left more than a 64th empty are opened again and their pieces dealt to fewer
    shards, until one shard is left or opening them no longer helps.
    """
    full = stored.where(F.col("length") >= most).select("uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rows, done, rounds = stored.where(F.col("length") < most).select("uid", "length"), [full], 0
    count = rows.count()
    while count:
        shards = -(-count // shard)
        dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(rounds), "uid"), F.lit(shards)))
        schema = "shard long, uid long, length long, bin long, offset long, open boolean"
        solved = staged(dealt.groupBy("shard").applyInArrow(_solver(most, nodes, most // 64), schema), "packing")
        again = solved.where("open").count() if shards > 1 else 0
        goes_on = 0 < again <= count // 2
        kept = solved.where("NOT open") if goes_on else solved
        number = F.lit(rounds << 56) + F.shiftleft("shard", 16) + F.col("bin")
        done.append(kept.select("uid", number.alias("sequence_id"), "offset"))
        rows, count, rounds = solved.where("open").select("uid", "length"), again if goes_on else 0, rounds + 1
    return functools.reduce(DataFrame.unionByName, done)


def pack_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", most: int = 2048, end: int = 0, with_ids: bool = False, shard: int = 8192, nodes: int = 20_000) -> DataFrame:
    """One row for each piece of each row of ``docs``: ``doc_id, piece, start, length, ids_crc32`` (``ids`` if asked), ``sequence_id, offset``.

    The pieces of a sequence stand at their offsets without gaps and have ``most`` ids together at most. A null or empty text is
    the id ``end`` alone. Repeated rows are packed as often as they stand, null ids too. No rows, no pieces. Columns of
    ``docs`` other than the two are not carried along.
    """
    stored = pieces(docs, path, doc_id, text, most, end, with_ids)
    plan = packed(stored.select("uid", "length"), most, shard, nodes)
    return stored.join(plan.withColumnRenamed("uid", "_uid"), F.col("uid") == F.col("_uid")).drop("uid", "_uid")


def sequences(packing: DataFrame) -> DataFrame:
    """``sequence_id, doc_ids, ids`` of every sequence of a packing made with ``ids``: its pieces' documents and all its token ids."""

    def joined(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            made = [np.frombuffer(b"".join(p["ids"] for p in parts), dtype="<u4").astype(np.int32) for parts in batch.column("parts").to_pylist()]
            docs = [[p["doc_id"] for p in parts] for parts in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("sequence_id"), pa.array(docs, pa.list_(pa.int64())), pa.array(made, pa.list_(pa.int32()))], ["sequence_id", "doc_ids", "ids"])

    parts = packing.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))
    return parts.mapInArrow(joined, "sequence_id long, doc_ids array<long>, ids array<int>")
