"""The trie of conversation prefixes: which beginnings conversations share, and what storing them once saves.

Turns get dictionary numbers. The distinct number sequences are sorted over range shards; a shard's sequences go into
ternary search trees, the middle one first, which keeps the trees balanced. One bottom-up walk adds up members, leaves
and savings. Only nodes on the border of a shard can be in another shard too: these are merged by key, and their
subtrees are summed by doubling the distance to the ancestor that gets the sum.

Sequences are cut into bands of ``band`` turns. A band hangs below the prefix before it, which is named by a
128-bit hash, so that a conversation of any length is never held in one task.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import dealt_join, drop_staged, staged, text_or_empty

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
#: Ids that one row carries to where an end list is hashed, and nodes of the trees held at once.
IDS, CHUNK = 1000, 200_000


def ordered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, pos, k1, k2, size`` of every turn: its place from 0, a 128-bit hash of role and text, and the text's UTF-8 bytes.

    Turns are ordered by ``turn`` (null first), then by role and text; a null role or text is empty. Rows without a
    conversation id belong to none and are left out. A conversation may be spread over many tasks: places are counted
    within tasks first, and one number for each task says where its first conversation goes on.
    """
    said = text_or_empty(f"`{text}`")
    rows = conversations.select(F.col(f"`{conv_id}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), text_or_empty(f"`{role}`").alias("role"), said.alias("text"))
    rows = rows.where("conv IS NOT NULL")
    dealt = rows.repartitionByRange("conv", "turn", F.left("role", F.lit(64)), F.left("text", F.lit(64))).sortWithinPartitions("conv", "turn", "role", "text")
    narrow = dealt.select("conv", F.xxhash64("role", "text").alias("k1"), F.xxhash64(F.lit("turn"), "text", "role").alias("k2"), F.octet_length("text").cast("long").alias("size"))

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held = TaskContext.get().partitionId(), None, 0
        for batch in source:
            conv = batch.column("conv").to_numpy()
            if len(conv):
                starts = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
                place = np.arange(len(conv)) - np.repeat(starts, np.diff(np.append(starts, len(conv))))
                if last == conv[0]:
                    place[: starts[1] if len(starts) > 1 else len(conv)] += held
                last, held = conv[-1], int(place[-1]) + 1
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(conv), part), pa.int32()), pa.array(place, pa.int64())], [*batch.schema.names, "part", "place"])

    local = staged(narrow.mapInArrow(count, "conv long, k1 long, k2 long, size long, part int, place long"), "turns")
    parts = local.groupBy("part").agg(F.min("conv").alias("head"), F.max("conv").alias("tail"), F.max(F.struct("conv", "place")).alias("end")).orderBy("part")
    before, begun = {}, []
    for p in parts.toLocalIterator():  # a row for each task
        if before.get(p["head"]):
            begun.append((p["part"], p["head"], before[p["head"]]))
        before = {p["tail"]: before.get(p["tail"], 0) + p["end"]["place"] + 1}
    offsets = F.broadcast(local.sparkSession.createDataFrame(begun, "_part int, _conv long, _more long"))
    joined = local.join(offsets, (F.col("part") == F.col("_part")) & (F.col("conv") == F.col("_conv")), "left")
    return joined.select("conv", (F.col("place") + F.coalesce("_more", F.lit(0))).alias("pos"), "k1", "k2", "size")


# --- trees of one shard -------------------------------------------------------------------------------

NODE = (
    "open boolean, depth long, k1 long, k2 long, p1 long, p2 long, first long, parent_first long, n long, size long, "
    "children long, leaves long, saved long, u1 long, u2 long"
)


class Trees:
    """Ternary search trees, one for each prefix that sequences hang below; a node's children are a binary tree of their own."""

    def __init__(self):
        self.turn: list[int] = []
        self.lower: list[int] = []
        self.equal: list[int] = []
        self.higher: list[int] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.size: list[int] = []
        self.members: list[int] = []
        self.first: list[int | None] = []
        self.open: list[bool] = []
        self.key: list[bytes | None] = []
        self.ends: list[tuple[int, int] | None] = []
        self.roots: dict[tuple, int] = {}

    def _node(self, turn: int, parent: int, depth: int, size: int) -> int:
        for column, value in ((self.turn, turn), (self.lower, -1), (self.equal, -1), (self.higher, -1), (self.parent, parent), (self.depth, depth), (self.size, size), (self.members, 0), (self.first, None), (self.open, False), (self.key, None), (self.ends, None)):
            column.append(value)
        return len(self.turn) - 1

    def root(self, depth: int, prefix: tuple[int, int]) -> int:
        if (depth, prefix) not in self.roots:
            made = self.roots[depth, prefix] = self._node(0, -1, depth, 0)
            self.open[made], self.key[made] = True, struct.pack("<qq", *prefix)
        return self.roots[depth, prefix]

    def child(self, node: int, turn: int, size: int) -> int:
        at, link = self.equal[node], self.equal
        came = node
        while at >= 0:
            if turn == self.turn[at]:
                return at
            came, link = at, self.lower if turn < self.turn[at] else self.higher
            at = link[at]
        link[came] = made = self._node(turn, node, self.depth[node] + 1, size)
        return made

    def insert(self, row: dict, depth: int, open_path: bool) -> None:
        node = self.root(depth, (row["P1"], row["P2"]))
        for turn, size in zip(row["ids"], row["sizes"]):
            node = self.child(node, turn, size)
            if open_path and not self.open[node]:
                self.open[node] = True
                self.key[node] = xxhash.xxh3_128_digest(self.key[self.parent[node]] + struct.pack("<q", turn))
        if row["goes_on"]:
            self.key[node] = struct.pack("<qq", row["U1"], row["U2"])
        self.members[node] += row["n"]
        self.first[node] = row["first"] if self.first[node] is None else min(self.first[node], row["first"])
        self.ends[node] = (row["U1"], row["U2"])

    def rows(self) -> dict[str, list]:
        """One row of ``NODE`` for each node: final numbers of closed nodes, sums over the closed children of open ones."""
        count = len(self.turn)
        children, leaves, saved = [0] * count, [0] * count, [0] * count
        for node in range(count - 1, -1, -1):  # children come after their parents
            if not self.open[node]:
                leaves[node] = leaves[node] or 1
                saved[node] += (self.members[node] - 1) * self.size[node]
            up = self.parent[node]
            if up >= 0:
                self.members[up] += self.members[node]
                self.first[up] = self.first[node] if self.first[up] is None else min(self.first[up], self.first[node])
                if not self.open[node]:
                    children[up] += 1
                    leaves[up] += leaves[node]
                    saved[up] += saved[node]
        out: dict[str, list] = {c.split()[0]: [] for c in NODE.split(", ")}
        for node in range(count):
            up = self.parent[node]
            below = up < 0 and self.depth[node] > 0  # the band before tells the members of this prefix
            own = struct.unpack("<qq", self.key[node]) if self.open[node] else (None, None)
            above = struct.unpack("<qq", self.key[up]) if up >= 0 and self.open[up] else (None, None)
            values = (
                self.open[node], self.depth[node], *own, *above, None if below else self.first[node],
                self.first[up] if up >= 0 and not self.open[up] else None, 0 if below else self.members[node], self.size[node],
                children[node], leaves[node], saved[node], *(self.ends[node] or (None, None)),
            )
            for column, value in zip(out.values(), values):
                column.append(value)
        return out


def _middles(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of every range before its halves."""
    ranges = [(0, n)]
    while ranges:
        a, b = ranges.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            ranges += [(middle + 1, b), (a, middle)]


def _shard_nodes(band: int, chunk: int):
    schema = pa.schema([(c.split()[0], pa.bool_() if c.endswith("boolean") else pa.int64()) for c in NODE.split(", ")])

    def grown(rows: list[dict]) -> pa.RecordBatch:
        trees = Trees()
        for k in _middles(len(rows)):
            trees.insert(rows[k], rows[k]["band"] * band, k in (0, len(rows) - 1) or rows[k]["goes_on"])
        return pa.RecordBatch.from_pydict(trees.rows(), schema=schema)

    def shard(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in source:
            for row in batch.to_pylist():
                rows.append(row)
                held += len(row["ids"]) + 1
                if held >= chunk:
                    yield grown(rows)
                    rows, held = [], 0
        if rows:
            yield grown(rows)

    return shard


# --- the whole trie -----------------------------------------------------------------------------------


def _bands(turns: DataFrame, lengths: DataFrame, band: int) -> DataFrame:
    """``conv, band, P1, P2, U1, U2, ids, sizes, goes_on``: a conversation's bands, the hash of what comes before one and of all up to its end."""
    entries = turns.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("held"), F.max("size").alias("size"))
    entries = staged(entries.withColumn("id", F.monotonically_increasing_id()), "dictionary")
    coded = dealt_join(turns.select("conv", "pos", "k1", "k2"), entries, ["k1", "k2"], "held")
    cut = coded.groupBy("conv", F.floor(F.col("pos") / band).alias("band")).agg(F.sort_array(F.collect_list(F.struct("pos", "id", "size"))).alias("t"))
    cut = cut.select("conv", "band", F.transform("t", lambda x: x["id"]).alias("ids"), F.transform("t", lambda x: x["size"]).alias("sizes"))
    none = lengths.where("total = 0").select("conv", F.lit(0).cast("long").alias("band"), F.array().cast("array<long>").alias("ids"), F.array().cast("array<long>").alias("sizes"))
    h1, h2 = F.xxhash64("ids"), F.xxhash64(F.lit("band"), "ids")
    some = F.size("ids") > 0
    e1, e2 = (F.when(some, F.xxhash64(*c)).otherwise(0).cast("long") for c in (["band", h1, h2], [F.lit("up"), "band", h2, h1]))
    rows = cut.unionByName(none).withColumns({"e1": e1, "e2": e2})
    long = lengths.where(F.col("total") > band).select(F.col("conv").alias("_conv"), "total")
    if long.isEmpty():
        zero = F.lit(0).cast("long")
        found = rows.withColumns({"P1": zero, "P2": zero, "goes_on": F.lit(False)})
    else:
        before = Window.partitionBy("conv").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
        rows = staged(rows, "bands")
        names = rows.select("conv", "band", "e1", "e2").join(long, F.col("conv") == F.col("_conv")).select(F.col("conv").alias("_c"), F.col("band").alias("_b"), "total", *(F.coalesce(F.bit_xor(e).over(before), F.lit(0)).cast("long").alias(p) for e, p in (("e1", "P1"), ("e2", "P2"))))
        joined = rows.join(names, (F.col("conv") == F.col("_c")) & (F.col("band") == F.col("_b")), "left")
        zero = F.lit(0).cast("long")
        found = joined.withColumns({"P1": F.coalesce("P1", zero), "P2": F.coalesce("P2", zero), "goes_on": F.coalesce(F.col("total") > (F.col("band") + 1) * band, F.lit(False))})
    up = [F.col(p).bitwiseXOR(F.col(e)).alias(u) for p, e, u in (("P1", "e1", "U1"), ("P2", "e2", "U2"))]
    return staged(found.select("conv", "band", "P1", "P2", *up, "ids", "sizes", "goes_on"), "sequences")


def _end_hashes(bands: DataFrame) -> DataFrame:
    """``U1, U2, sha``: SHA-256 of the ids of the conversations that end there, in order.

    A list of ids may be spread over tasks: pieces of it travel as rows and are hashed one after the other, which a hash
    of the whole list cannot do otherwise; no list is held whole.
    """
    rows = bands.where("NOT goes_on").select("U1", "U2", "conv").repartitionByRange("U1", "U2", "conv").sortWithinPartitions("U1", "U2", "conv")
    names, types = ["U1", "U2", "at", "ids", "sha"], [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def batch_of(made: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names)

    def listed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, whole, out = None, [], False, []

        def close(last: bool) -> None:
            if ids:
                text = ",".join(map(str, ids))
                out.append((*key, ids[0], None, hashlib.sha256(text.encode()).hexdigest()) if whole and not last else (*key, ids[0], text, None))

        for batch in source:
            u1, u2, conv = (batch.column(c).to_numpy() for c in ("U1", "U2", "conv"))
            starts = np.flatnonzero(np.append(True, (u1[1:] != u1[:-1]) | (u2[1:] != u2[:-1]))) if len(conv) else []
            for a, b in zip(starts, [*starts[1:], len(conv)]):
                if (u1[a], u2[a]) != key:
                    close(False)
                    whole, key, ids = key is not None, (int(u1[a]), int(u2[a])), []
                for start in range(a, b, IDS):
                    ids += conv[start : min(b, start + IDS)].tolist()
                    if len(ids) >= IDS:
                        whole = False
                        close(True)
                        ids = []
            if len(out) >= IDS:
                yield batch_of(out)
                out = []
        close(True)
        if out:
            yield batch_of(out)

    pieces = staged(rows.mapInArrow(listed, "U1 long, U2 long, at long, ids string, sha string"), "ends")

    def hashed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in source:
            out = []
            for u1, u2, ids in zip(*(batch.column(c).to_pylist() for c in ("U1", "U2", "ids"))):
                if (u1, u2) != key:
                    if key:
                        out.append((*key, digest.hexdigest()))
                    key, digest = (u1, u2), hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["U1", "U2", "sha"])
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, digest.hexdigest())], ["U1", "U2", "sha"])

    spread = pieces.where("ids IS NOT NULL").repartition("U1", "U2").sortWithinPartitions("U1", "U2", "at").select("U1", "U2", "ids")
    return pieces.where("sha IS NOT NULL").select("U1", "U2", "sha").unionByName(spread.mapInArrow(hashed, "U1 long, U2 long, sha string"))


KEY = ["depth", "k1", "k2"]


def _merged(nodes: DataFrame) -> DataFrame:
    """The open nodes, each once, with the numbers of their whole subtrees."""
    additive = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    same = [F.max(c).alias(c) for c in ("size", "p1", "p2", "u1", "u2")]
    once = staged(nodes.where("open").groupBy(*KEY).agg(*additive, *same, F.min("first").alias("first")), "border")
    more = once.where("p1 IS NOT NULL").groupBy((F.col("depth") - 1).alias("_d"), F.col("p1").alias("_1"), F.col("p2").alias("_2")).agg(F.count(F.lit(1)).alias("_more"))
    joined = once.join(more, (F.col("depth") == F.col("_d")) & (F.col("k1") == F.col("_1")) & (F.col("k2") == F.col("_2")), "left")
    children = F.col("children") + F.coalesce("_more", F.lit(0))
    sums = {"children": children, "leaves": F.col("leaves") + (children == 0).cast("long"), "saved": F.col("saved") + (F.col("n") - 1) * F.col("size")}
    tree = staged(joined.withColumns(sums).select(*once.columns, F.col("p1").alias("j1"), F.col("p2").alias("j2")), "border")
    deepest, far = once.agg(F.max("depth")).first()[0] or 0, 1
    while far <= deepest:
        given = tree.where("j1 IS NOT NULL").groupBy((F.col("depth") - far).alias("_d"), F.col("j1").alias("_1"), F.col("j2").alias("_2")).agg(F.sum("leaves").alias("_l"), F.sum("saved").alias("_s"))
        summed = tree.join(given, (F.col("depth") == F.col("_d")) & (F.col("k1") == F.col("_1")) & (F.col("k2") == F.col("_2")), "left")
        summed = summed.withColumns({"leaves": F.col("leaves") + F.coalesce("_l", F.lit(0)), "saved": F.col("saved") + F.coalesce("_s", F.lit(0))}).select(*tree.columns)
        up = tree.select((F.col("depth") + far).alias("_d"), F.col("k1").alias("_1"), F.col("k2").alias("_2"), F.col("j1").alias("_j1"), F.col("j2").alias("_j2"))
        reach = summed.where(F.col("depth") >= 2 * far).join(up, (F.col("depth") == F.col("_d")) & (F.col("j1") == F.col("_1")) & (F.col("j2") == F.col("_2")), "left")
        reach = reach.withColumns({"j1": F.col("_j1"), "j2": F.col("_j2")}).select(*tree.columns)
        done = summed.where(F.col("depth") < 2 * far).withColumns({"j1": F.lit(None).cast("long"), "j2": F.lit(None).cast("long")})
        turned = staged(reach.unionByName(done), "border")
        drop_staged(tree)
        tree, far = turned, 2 * far
    return tree.drop("j1", "j2")


def prefix_trie(turns: DataFrame, lengths: DataFrame, band: int = 512, chunk: int = CHUNK) -> DataFrame:
    """One row for each distinct beginning of conversations: ``conv_id, depth`` (it is the first ``depth`` turns of that
    conversation, the smallest member), ``parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``turns`` are stored rows like those of ``ordered_turns``, ``lengths`` has ``conv, total`` of every conversation, those
    without turns included: they are members of the root alone. ``saved_tokens`` counts UTF-8 bytes: of every
    node of the subtree (members - 1) times its last text. Repeated conversations are members of the same nodes. No
    conversation, no node. ``band`` and ``chunk`` bound what a task holds, and change no result.
    """
    bands = _bands(turns, lengths, band)
    order = ["band", "P1", "P2", "ids"]
    rows = bands.groupBy("band", "P1", "P2", "U1", "U2", "ids", "sizes").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("first"), F.max("goes_on").alias("goes_on"))
    sequences = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    nodes = staged(sequences.mapInArrow(_shard_nodes(band, chunk), NODE), "nodes")
    border = _merged(nodes)
    closed = nodes.where("NOT open")
    above = border.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("first").alias("up"), F.col("children").alias("held"))
    number = [F.col("first").alias("conv_id"), "depth"], ["n", "children", "leaves", "saved", "u1", "u2"]
    inside = closed.where("p1 IS NULL").select(*number[0], F.col("parent_first").alias("up"), *number[1])
    below = dealt_join(closed.where("p1 IS NOT NULL"), above, ["depth", "p1", "p2"], "held").select(*number[0], "up", *number[1])
    edge = dealt_join(border, above, ["depth", "p1", "p2"], "held").select(*number[0], "up", *number[1])
    every = staged(inside.unionByName(below).unionByName(edge), "trie")
    known = _with_ends(every, _end_hashes(bands))
    return known.select("conv_id", "depth", F.col("up").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def _with_ends(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """``nodes`` with ``sha`` where conversations may end; the others stay out of the shuffle."""
    ends = ends.select(F.col("U1").alias("_1"), F.col("U2").alias("_2"), "sha")
    marked = nodes.where("u1 IS NOT NULL").join(ends, (F.col("u1") == F.col("_1")) & (F.col("u2") == F.col("_2")), "left").drop("_1", "_2")
    return marked.unionByName(nodes.where("u1 IS NULL").withColumn("sha", F.lit(None).cast("string")))
