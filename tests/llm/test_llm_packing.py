import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from indicata.llm.packing import UNUSUAL, Encoder, Shard, best_fit, cut, lower_bound, pack_documents, pack_shard, packed, sequences

PATH = public_tokenizers.path("byte_bpe_50k.json")


def fewest(lengths, most):
    """The smallest number of bins, by trying every bin for every piece."""
    best, lengths = [len(lengths)], sorted(lengths, reverse=True)

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(bins)
            return
        for i in {b: i for i, b in enumerate(bins)}.values():
            if bins[i] + lengths[k] <= most:
                bins[i] += lengths[k]
                place(k + 1, bins)
                bins[i] -= lengths[k]
        place(k + 1, [*bins, lengths[k]])

    place(0, [])
    return best[0]


def test_small_shards_are_packed_best():
    rng = random.Random(1)
    for _ in range(300):
        most = rng.choice([10, 30, 100])
        lengths = [rng.randint(1, most) for _ in range(rng.randint(1, 11))]
        bins, wanted = pack_shard(lengths, most), fewest(lengths, most)
        assert sorted(x for b in bins for x in b) == sorted(lengths) and all(sum(b) <= most for b in bins)
        assert len(bins) == wanted >= lower_bound(lengths, most)


def test_search_beats_best_fit():
    rng = random.Random(5)
    lengths = [rng.randint(500, 800) for _ in range(600)]
    bins = pack_shard(lengths, 2048, nodes=3000)
    assert len(bins) < len(best_fit(lengths, 2048)) and sorted(x for b in bins for x in b) == sorted(lengths)


def test_fillings_are_undominated_and_leave_the_shard_alone():
    rng = random.Random(2)
    for _ in range(50):
        lengths = [rng.randint(2, 30) for _ in range(12)]
        shard = Shard(lengths, 40)
        before = (shard.counts.copy(), shard.left, shard.turned)
        found = list(shard.fillings(40, 40, 10_000))
        assert (shard.counts, shard.left, shard.turned) == before
        assert len({f for f, _ in found}) == len(found) and all(sum(f) + w == 40 for f, w in found)
        for filling, waste in found[:-1]:
            rest = list(lengths)
            for x in filling:
                rest.remove(x)
            assert all(x > waste for x in rest), "a piece could be added"
            assert not any(y < x <= y + waste for y in filling for x in rest), "a longer piece could stand for one"


@pytest.mark.parametrize("length, wanted", [(1, [(0, 1)]), (8, [(0, 8)]), (9, [(0, 1), (1, 8)]), (24, [(0, 8), (8, 8), (16, 8)])])
def test_only_the_first_piece_is_shorter(length, wanted):
    assert list(cut(length, 8)) == wanted


TEXTS = ["Hello world, it's 2024 — don't\n\n panic!  ", "", "Straße über Ärger naïve", "日本語のテキスト ok", "<|endoftext|> is special", "x" * 4000, " " * 700 + "a", "\U0001f600 emoji\x1d\x85", "क्षत्रिय"]


def test_ids_are_the_tokenizers():
    own, plain = Encoder(PATH), Tokenizer.from_file(PATH)
    assert own.merger is not None
    signs = [c for c in map(chr, range(0x3000)) if not UNUSUAL.search(c)]
    texts = TEXTS + [f"a{c}b {c}1{c}{c} {c} x" for c in signs]
    assert own.encode(texts) == [struct.pack(f"<{len(i)}I", *i) for i in (plain.encode(t, add_special_tokens=False).ids for t in texts)]


def test_documents_come_back_from_their_sequences(spark):
    rng = random.Random(3)
    texts = TEXTS + [None] + [" ".join(rng.choices(["alpha", "beta ", "gamma7", "é"], k=rng.randint(1, 400))) for _ in range(60)]
    rows = [(k if k % 7 else None, t, "x", 5) for k, t in enumerate(texts)] + [(3, texts[3], "y", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece string, uid int")
    packing = pack_documents(docs, PATH, most=128, with_ids=True, shard=40)
    found = packing.collect()
    plain = Tokenizer.from_file(PATH)
    wanted = sorted(((r[0], tuple(plain.encode(r[1] or "", add_special_tokens=False).ids) + (0,)) for r in rows), key=repr)
    by_piece, bins = defaultdict(list), defaultdict(list)
    for r in found:
        ids = struct.unpack(f"<{r['length']}I", r["ids"])
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and r["length"] <= 128
        bins[r["sequence_id"]].append((r["offset"], r["length"], ids, r["doc_id"]))
        by_piece[r["doc_id"], r["piece"]].append((r["start"], r["length"], ids))
    for pieces in bins.values():
        pieces.sort()
        assert [o for o, *_ in pieces] == [sum(n for _, n, *_ in pieces[:k]) for k in range(len(pieces))] and sum(n for _, n, *_ in pieces) <= 128
    assert len(found) == sum(len(list(cut(len(ids), 128))) for _, ids in wanted)
    one = {d for d, _ in wanted if [x for x, _ in wanted].count(d) == 1}
    for doc, ids in wanted:
        if doc in one:
            parts = sorted(p for (d, _), ps in by_piece.items() if d == doc for p in ps)
            assert tuple(x for _, _, i in parts for x in i) == ids and all(n == 128 for _, n, _ in parts[1:])
    whole = {r["sequence_id"]: (r["doc_ids"], tuple(r["ids"])) for r in sequences(packing).collect()}
    assert whole == {s: ([d for *_, d in p], tuple(x for _, _, i, _ in p for x in i)) for s, p in bins.items()}


def test_shards_cost_few_sequences(spark):
    rng = random.Random(4)
    lengths = [rng.randint(1, 900) for _ in range(3000)] + [2048] * 5
    stored = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    found = packed(stored, shard=300).collect()
    assert sorted(r["uid"] for r in found) == list(range(3005))
    assert len({r["sequence_id"] for r in found}) <= lower_bound(lengths, 2048) + 2


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(docs, PATH).count() == 0
