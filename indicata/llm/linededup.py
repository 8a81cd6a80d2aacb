"""Fuzzy lines across documents, reduced to one occurrence for each connected group.

Lines are normalised (small letters and digits, one space between words) and compared by
64-bit SimHash. The bits are cut into blocks; lines that agree on any ``intact`` of them are
candidates, which finds all pairs up to ``blocks - intact`` bits apart and most of those a
few bits further, the same ones in a small table and in a large one. The share of words
that need no edit decides. A changed word moves about six of a hundred bits: of pairs of
similarity 0.98 nine in ten are found, below that fewer (a test measures it against all pairs).
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import dealt_join, drop_staged, packed, staged, text_or_empty

BITS = 64
#: What separates words within a line: all ASCII but digits, small letters and the line break.
BETWEEN = r"\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F"
#: Letters of scripts that put no space between words; all of them stand behind the characters of ``EARLY``.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
EARLY = r"\u0000-\u0DFF"
#: Words whose votes are counted at once: eight numbers of seven bits stand in one long, so eight longs count 64 bits.
SLICE, LANE, ONES = 127, 8, 0x0101010101010101
#: Different words of a line whose votes are added bit by bit, by compiled code without a loop; longer lines are counted by slices.
UNROLLED = 126
#: Lines of a crowded key that meet all lines of the key in one task.
SLOT = 1024
#: Keys, lines or texts whose numbers are sent to the tasks; more are joined by a shuffle.
SENT = 1 << 20
#: The same for lists of places, in bytes.
SENT_BYTES = 1 << 26
#: Keys that one task counts, about.
KEYS = 1 << 20
#: Code points for the signs of words: 4 bytes each in UTF-8.
SIGNS = 1 << 20


def normal_lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``doc, body, pos, norm`` of every line: small letters and digits, one space between words.

    ``doc`` and ``body`` (a hash of the text) name the row. Every letter of a script without spaces is a word.
    """
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc"), text_or_empty(f"`{text}`").alias("_text"))
    small = F.lower("_text")
    apart = (F.octet_length("_text") > F.char_length("_text")) & F.col("_text").rlike(f"[^{EARLY}]")
    spaced = F.when(apart, F.regexp_replace(small, f"({UNSPACED})", " $1 ")).otherwise(small)
    plain = F.regexp_replace(spaced, f"[{BETWEEN}]+", " ")
    # Hashed below the split, or a text would be hashed for each of its lines. The outer form: for the inner one the optimizer
    # adds a filter that splits every text a second time.
    whole = texts.select("doc", F.xxhash64("_text").alias("body"), F.split(plain, "\n").alias("_lines"))
    lines = whole.select("doc", "body", F.posexplode_outer("_lines").alias("pos", "line"))
    return lines.select("doc", "body", "pos", F.btrim("line").alias("norm"))


def _counts(hashes: Column) -> Column:
    """How many of at most ``SLICE`` hashes have each bit: bit ``8 k + j`` is counted in the k-th lane of the j-th long."""

    def added(counts: Column, h: Column) -> Column:
        return F.array(*(F.get(counts, F.lit(j)) + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(ONES)) for j in range(LANE)))

    return F.aggregate(hashes, F.array(*(F.lit(0).cast("long") for _ in range(LANE))), added)


def _full(a: Column, b: Column, c: Column) -> tuple[Column, Column]:
    """Three numbers added bit by bit: the bits of weight one and those of weight two."""
    odd = a.bitwiseXOR(b)
    return odd.bitwiseXOR(c), a.bitwiseAND(b).bitwiseOR(odd.bitwiseAND(c))


def _seven(a: Column, b: Column, c: Column, d: Column, e: Column, f: Column, g: Column) -> tuple[Column, Column, Column]:
    """The same for seven numbers: bits of weight one, two and four."""
    one, x = _full(a, b, c)
    one, y = _full(one, d, e)
    one, z = _full(one, f, g)
    return one, *_full(x, y, z)


def _added(planes: list[list[Column]]) -> list[list[Column]]:
    """The numbers of every weight (one, two, four, ...) added in groups; what they sum up to stays, there are fewer."""
    out: list[list[Column]] = [[] for _ in range(len(planes) + 2)]
    for k, numbers in enumerate(planes):
        while numbers:
            size = next(s for s in (7, 3, 2, 1) if len(numbers) >= s)
            group, numbers = numbers[:size], numbers[size:]
            sums = {7: _seven, 3: _full, 2: lambda a, b: (a.bitwiseXOR(b), a.bitwiseAND(b)), 1: lambda a: (a,)}[size](*group)
            for up, number in enumerate(sums):
                out[k + up].append(number)
    return out[: UNROLLED.bit_length()]


def _exceeds(planes: list[Column], limit: Column) -> Column:
    """The bits whose count, given by one number for each weight, is above ``limit``."""
    above = F.lit(0).cast("long")
    for k, bits in enumerate(planes):
        unset = (F.shiftright(limit, k).bitwiseAND(F.lit(1)) - 1).cast("long")
        above = bits.bitwiseAND(unset).bitwiseOR(bits.bitwiseOR(unset).bitwiseAND(above))
    return above


def _majority(slices: Column, n: Column) -> Column:
    """The bits that more than half of ``n`` hashes have, from the counts of any number of slices."""

    def lane(counts: Column, at: Column) -> Column:
        j = F.pmod(at, F.lit(LANE))
        return F.call_function("shiftrightunsigned", F.get(counts, j), at - j).bitwiseAND(F.lit(SLICE).cast("long"))

    def joined(sim: Column, at: Column) -> Column:
        votes = F.aggregate(slices, F.lit(0).cast("long"), lambda s, counts: s + lane(counts, at))
        return sim.bitwiseOR(F.when(2 * votes > n, F.call_function("shiftleft", F.lit(1).cast("long"), at)).otherwise(F.lit(0).cast("long")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), joined)


def hashed_lines(lines: DataFrame, min_words: int) -> DataFrame:
    """``doc, body, pos, line_id, n, sim, norm`` of the lines with words: a hash of the words, their number, and for at least
    ``min_words`` words the SimHash of the different ones and the words themselves (else null)."""
    split = lines.where("norm != ''").withColumn("_w", F.split("norm", " "))
    enough = F.size("_w") >= min_words
    hashed = split.withColumns({"n": F.size("_w"), "line_id": F.xxhash64("norm"), "_h": F.when(enough, F.array_distinct(F.transform("_w", lambda w: F.xxhash64(w))))})
    one = F.size("_h") <= UNROLLED
    long = F.transform(F.sequence(F.lit(1), F.size("_h"), F.lit(SLICE)), lambda start: _counts(F.slice("_h", start, F.lit(SLICE))))
    kept = ["doc", "body", "pos", "line_id", "n", "norm", "_m"]
    planes = _added([[F.coalesce(F.get("_h", F.lit(at)), F.lit(0).cast("long")) for at in range(UNROLLED)]])
    first, counted = [F.size("_h").alias("_m"), F.when(~one, long).alias("_all")], hashed
    # Every round of additions is a projection of its own, so that no number is computed for each of its uses.
    while True:
        named = [[number.alias(f"_p{k}_{i}") for i, number in enumerate(numbers)] for k, numbers in enumerate(planes)]
        counted = counted.select(*(kept[:-1] if first else [*kept, "_all"]), *first, *(number for numbers in named for number in numbers))
        first, planes = [], [[F.col(f"_p{k}_{i}") for i in range(len(numbers))] for k, numbers in enumerate(planes)]
        if all(len(numbers) <= 1 for numbers in planes):
            break
        planes = _added(planes)
    limit = F.floor(F.col("_m") / 2).cast("int")
    sim = F.when(F.col("_m") <= UNROLLED, _exceeds([numbers[0] for numbers in planes], limit)).when(F.col("_m") > UNROLLED, _majority(F.col("_all"), F.col("_m")))
    return counted.select("doc", "body", "pos", "line_id", "n", sim.alias("sim"), F.when(F.col("n") >= min_words, F.col("norm")).alias("norm"))


def word_signs(hashes: Column) -> Column:
    """Hashed words as a text of one sign each, out of 2**20: edits of words are edits of signs."""

    def sign(h: Column) -> Column:
        code = F.pmod(h, F.lit(SIGNS)) + 0x10000
        six = lambda at: F.shiftright(code, at).bitwiseAND(F.lit(63).cast("long"))
        bytes_of = F.lit(0xF0808080) + F.shiftleft(F.shiftright(code, 18), 24) + F.shiftleft(six(12), 16) + F.shiftleft(six(6), 8) + six(0)
        return F.hex(bytes_of)

    return F.unhex(F.array_join(F.transform(hashes, sign), "")).cast("string")


def _masks(blocks: int, intact: int) -> list[int]:
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [reduce(int.__or__, pick) for pick in combinations(parts, intact)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _near(far_bits: int, least: float) -> Column:
    """Lines ``line_id, sim, n`` and ``b, t, m``: not too many bits apart, and not ruled out by their numbers of words."""
    return (F.bit_count(F.col("sim").bitwiseXOR(F.col("t"))) <= far_bits) & (F.least("n", "m") >= least * F.greatest("n", "m"))


def _other(keyed: DataFrame, *more: Column) -> DataFrame:
    return keyed.select(F.col("key").alias("k"), F.col("line_id").alias("b"), F.col("sim").alias("t"), F.col("n").alias("m"), *more)


def _sent(numbers: DataFrame) -> DataFrame:
    """A stored table of a few numbers a row, to be sent to the tasks if it has at most ``SENT`` rows."""
    return F.broadcast(numbers) if numbers.count() <= SENT else numbers


def searched(lines: DataFrame, max_bits: int, intact: int, far_bits: int, crowded: int, least: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Pairs ``a, b`` of the keys held by at most ``crowded`` lines, and ``key, line_id, sim, n`` of the fuller keys.

    Keys are counted with partial sums, so that no key is gathered. Two lines of a key need no join: the sums hold
    their ids, their different bits and their numbers of words.
    """
    masks = _masks(max_bits + intact, intact)
    few = lines.where("sim IS NOT NULL").select("line_id", "sim", "n")
    tasks = 1 + few.count() * len(masks) // KEYS

    def keys(of: DataFrame) -> DataFrame:
        rows = of.select("line_id", "sim", "n", F.explode(F.array(*(F.lit(_signed(m)) for m in masks))).alias("mask"))
        return rows.select(F.xxhash64("mask", F.col("sim").bitwiseAND(F.col("mask"))).alias("key"), "line_id", "sim", "n")

    # Dealt evenly first, as nearly every key is held by one line and sums within a task save little.
    keyed = keys(few.repartition(tasks, "line_id"))
    ends = [F.min("line_id").alias("a"), F.max("line_id").alias("b"), F.bit_xor("sim").alias("x"), F.min("n").alias("low"), F.max("n").alias("high")]
    held = staged(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("held"), *ends).where("held > 1"), "keys")
    two = held.where((F.col("held") == 2) & (F.bit_count("x") <= far_bits) & (F.col("low") >= least * F.col("high")) & (F.col("a") != F.col("b"))).select("a", "b")
    more = held.where("held > 2").select(F.col("key").alias("k"), "held")
    several = staged(keys(few).join(_sent(more), F.col("key") == F.col("k")).drop("k"), "several")
    few = several.where(F.col("held") <= crowded).drop("held")
    met = few.join(_other(few), F.col("key") == F.col("k")).where((F.col("line_id") < F.col("b")) & _near(far_bits, least)).select(F.col("line_id").alias("a"), "b")
    pairs = staged(two.union(met).distinct(), "pairs")
    crowd = staged(several.where(F.col("held") > crowded).drop("held"), "crowd")
    for table in (held, several):
        drop_staged(table)
    return pairs, crowd


def _stars(crowd: DataFrame, far_bits: int, least: float) -> DataFrame:
    """``a, b``: the lines of every key with the first line of it."""
    first = crowd.groupBy("key").agg(F.min(F.struct("line_id", "sim", "n")).alias("f")).select("key", "f.*")
    return crowd.join(_other(first), F.col("key") == F.col("k")).where((F.col("line_id") != F.col("b")) & _near(far_bits, least)).select(F.col("b").alias("a"), F.col("line_id").alias("b")).distinct()


def crossing(crowd: DataFrame, far_bits: int, least: float = 0.0) -> DataFrame:
    """``a, b``: all pairs of ``crowd`` (``key, line_id, sim, n, root``) that share a key, not a root, and are at most ``far_bits`` apart.

    A key of one root alone goes before the join. The lines of the others are dealt to slots of about ``SLOT``
    lines, and every slot meets all lines of the key, so that no task holds all pairs of a key.
    """
    mixed = crowd.groupBy("key").agg(F.count(F.lit(1)).alias("held"), F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    rows = crowd.join(mixed.select("key", F.ceil(F.col("held") / SLOT).cast("int").alias("slots")), "key")
    other = _other(rows, F.col("root").alias("other"), F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("at"))
    met = rows.withColumn("slot", F.pmod(F.xxhash64("line_id"), F.col("slots")).cast("int")).join(other, (F.col("key") == F.col("k")) & (F.col("slot") == F.col("at")))
    return met.where((F.col("line_id") < F.col("b")) & (F.col("root") != F.col("other")) & _near(far_bits, least)).select(F.col("line_id").alias("a"), "b").distinct()


def candidates(lines: DataFrame, max_bits: int, intact: int, far_bits: int, crowded: int, least: float = 0.0) -> DataFrame:
    """``a, b``: all pairs of ``lines`` (``line_id, sim, n``) that share a key and are at most ``far_bits`` apart.

    Pairs whose numbers of words alone rule out an edit similarity of ``least`` are left out. ``crowded`` decides
    how the pairs are found, not which.
    """
    pairs, crowd = searched(lines, max_bits, intact, far_bits, crowded, least)
    return pairs.union(crossing(crowd.withColumn("root", F.col("line_id")), far_bits, least)).distinct()


def _paired_signs(words: Column, both: Column) -> Column:
    """Hashed words as signs that are their places in ``both``, the different words of a pair."""
    return word_signs(F.transform(words, lambda w: F.array_position(both, w).cast("long")))


def _verified(pairs: DataFrame, words: DataFrame, least: float, others: DataFrame | None = None) -> DataFrame:
    """The pairs with an edit similarity of at least ``least``: one less the edits of words over the longer line's words.

    ``words`` has the lines ``a``, ``others`` (``words`` unless given) the lines ``b``.

    An edit takes away one word at most, so lines that differ in too many words are told apart without alignment. Where
    two different words of a pair have the same sign, the pair is aligned by signs of its own.
    """
    one = words.select(F.col("line_id").alias("a"), F.col("signs").alias("x"), F.col("hashes").alias("_xs"))
    other = (words if others is None else others).select(F.col("line_id").alias("b"), F.col("signs").alias("y"), F.col("hashes").alias("_ys"))
    longer = F.greatest(F.size("_xs"), F.size("_ys"))
    allowed = F.floor(longer * (1 - least) + 1e-9).cast("int")
    few = (F.size(F.array_except("_xs", "_ys")) <= allowed) & (F.size(F.array_except("_ys", "_xs")) <= allowed)
    near = pairs.join(one, "a").join(other, "b").where((F.abs(F.size("_xs") - F.size("_ys")) <= allowed) & few)
    both = near.withColumns({"_both": F.array_distinct(F.concat("_xs", "_ys")), "_allowed": allowed})
    clear = F.size("_both") == F.size(F.array_distinct(F.transform("_both", lambda h: F.pmod(h, F.lit(SIGNS)))))
    edits = lambda a, b: F.call_function("levenshtein", a, b, F.col("_allowed")) >= 0
    own = edits(_paired_signs(F.col("_xs"), F.col("_both")), _paired_signs(F.col("_ys"), F.col("_both")))
    return both.where(F.when(clear, edits(F.col("x"), F.col("y"))).otherwise(own)).select("a", "b")


def _words_of(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """``line_id, left, right, hashes, signs`` of the wanted lines (``line_id, left, right, at``), each from the place ``at``."""
    placed = lines.where("sim IS NOT NULL").select(F.xxhash64("doc", "body", "pos").alias("place"), "norm")
    # Rows of the same id and text have the same places.
    found = placed.join(_sent(wanted), F.col("place") == F.col("at")).select("line_id", "left", "right", "norm").distinct()
    hashed = found.select("line_id", "left", "right", F.transform(F.split("norm", " "), lambda w: F.xxhash64(w)).alias("hashes"))
    return hashed.select("line_id", "left", "right", "hashes", word_signs(F.col("hashes")).alias("signs"))


def _crossed(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs ``a, b`` whose lines are not in one group of ``roots`` (``node, root``)."""
    of = lambda c, name: roots.select(F.col("node").alias(f"_{c}"), F.col("root").alias(name))
    met = pairs.join(of("a", "_ra"), F.col("a") == F.col("_a"), "left").join(of("b", "_rb"), F.col("b") == F.col("_b"), "left")
    return met.where(F.coalesce("_ra", "a") != F.coalesce("_rb", "b")).select("a", "b")


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 5, least: float = 0.8, max_bits: int = 3, far_bits: int = 10, intact: int = 2, crowded: int = 64) -> tuple[DataFrame, DataFrame]:
    """All lines with words (``doc, body, pos, line_id``), and those that stand several times or have a like line
    (``line_id, root, held, lines``): their group, how often the line stands and the number of lines in the group."""
    lines = staged(hashed_lines(normal_lines(docs, doc_id, text), min_words), "lines")
    each = lines.select("line_id", "sim", "n", F.xxhash64("doc", "body", "pos").alias("at"))
    distinct = staged(each.groupBy("line_id").agg(F.max("sim").alias("sim"), F.max("n").alias("n"), F.min("at").alias("at"), F.count(F.lit(1)).alias("held")), "distinct")
    pairs, crowd = searched(distinct.select("line_id", "sim", "n"), max_bits, intact, far_bits, crowded, least)
    # Every line with the first one it is paired with, and those of a crowded key with its first: what these link needs no other pair.
    first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    crowded_keys = not crowd.isEmpty()
    first = staged(first.union(_stars(crowd, far_bits, least)).distinct() if crowded_keys else first, "first")
    side = lambda of, c, left, right: of.select(F.col(c).alias("line_id"), F.lit(left).alias("left"), F.lit(right).alias("right"))
    sides = reduce(DataFrame.union, (side(first, "a", True, False), side(first, "b", False, True), side(pairs, "a", False, False), side(crowd, "line_id", False, False)))
    needed = staged(sides.groupBy("line_id").agg(F.max("left").alias("left"), F.max("right").alias("right")), "needed")
    wanted = staged(distinct.select("line_id", "at").join(_sent(needed), "line_id"), "wanted")
    words = staged(_words_of(lines, wanted), "words")
    roots = components(_verified(first, words.where("left"), least, words.where("right")), "a", "b")
    crossed = staged(_crossed(pairs, roots), "crossed")
    spent = [pairs, crowd, first, needed, wanted, words, crossed]
    rest = crossed
    if crowded_keys:
        rooted = staged(crowd.join(roots, F.col("line_id") == F.col("node"), "left").select("key", "line_id", "sim", "n", F.coalesce("root", "line_id").alias("root")), "rooted")
        crossing_keys = staged(crossing(rooted, far_bits, least), "crossing")
        spent += [rooted, crossing_keys]
        rest = crossed.union(crossing_keys).distinct()
    more = staged(_verified(rest, words, least), "more")
    spent.append(more)
    if not more.isEmpty():
        spent.append(roots)
        roots = components(more.union(roots), "a", "b")
    # All other lines stand once and alone; they go before anything is joined.
    grouped = staged(roots.select("node", "root").union(roots.select(F.col("root").alias("node"), "root").distinct()), "grouped")
    held = distinct.select("line_id", "held").join(_sent(grouped), F.col("line_id") == F.col("node"), "left").where("root IS NOT NULL OR held > 1")
    held = staged(held.select("line_id", F.coalesce("root", "line_id").alias("root"), "held"), "classes")
    groups = staged(held.groupBy("root").agg(F.count(F.lit(1)).alias("lines")).withColumn("of", F.col("lines")), "sizes")
    members = staged(dealt_join(held, groups, ["root"], "of"), "members")
    for table in [*spent, distinct, roots, grouped, held, groups]:
        drop_staged(table)
    return lines, members


def occurrences(lines: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Where the lines of ``members`` stand (``place, root, lines``), and for every group the place that stays, its places and lines
    (``root, keep, places, of``): the first by document id, text hash and place in the text."""
    place = F.struct("doc", "body", "pos").alias("place")
    seen = dealt_join(lines.select("doc", "body", "pos", "line_id"), members, ["line_id"], "held").where("root IS NOT NULL")
    seen = staged(seen.select(place, "root", "lines"), "places")
    kept = seen.groupBy("root").agg(F.min("place").alias("keep"), F.count(F.lit(1)).alias("places"), F.max("lines").alias("of"))
    return seen, staged(kept, "kept")


def line_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> tuple[DataFrame, DataFrame]:
    """All lines with words (``doc, body, pos, line_id``), and of every group of several the occurrence that stays
    (``line_id, keep, held``): the first by document id, text hash and place; ``held`` is how often the line stands."""
    lines, members = repeated_lines(docs, doc_id, text, **options)
    seen, kept = occurrences(lines, members)
    groups = staged(dealt_join(members, kept.select("root", "keep", "of"), ["root"], "of").select("line_id", "keep", "held"), "groups")
    for table in (members, seen, kept):
        drop_staged(table)
    return lines, groups


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """All columns of ``docs`` with the repeated lines taken out of the text, then ``n_lines`` and ``n_removed``.

    Lines of fewer than ``min_words`` words (five) are repeated only if their words are equal; lines without words stay
    wherever they are. A text that loses no line comes back as it was, null
    included; one that loses all of them is empty. Rows equal in id and text are one occurrence and lose the same lines.
    """
    lines, members = repeated_lines(docs, doc_id, text, **options)
    seen, kept = occurrences(lines, members)
    repeated = dealt_join(seen.select("place", "root"), kept.drop("of"), ["root"], "places").where(~F.col("place").eqNullSafe(F.col("keep")))
    gone = staged(repeated.groupBy(F.col("place.doc").alias("_doc"), F.col("place.body").alias("_body")).agg(F.collect_set("place.pos").alias("_gone")), "gone")
    for table in (lines, members, seen, kept):
        drop_staged(table)
    results = ("n_lines", "n_removed")
    body = text_or_empty(f"`{text}`")
    rows = docs.select(packed(docs, text, *results), F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"), F.xxhash64(body).alias("_own"))
    sent = gone.agg(F.sum(4 * F.size("_gone") + 32)).first()[0] or 0
    joined = rows.join(F.broadcast(gone) if sent <= SENT_BYTES else gone, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_own") == F.col("_body")), "left")
    parts = joined.withColumn("_parts", F.split(text_or_empty("_text"), "\n"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), "_gone"), lambda i: F.get("_parts", i))
    left = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n"))
    return parts.select(
        *((left if c == text else F.col("own").getField(c)).alias(c) for c in docs.columns if c not in results),
        F.size("_parts").cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
    )
