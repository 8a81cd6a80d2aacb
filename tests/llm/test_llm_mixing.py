import random
from fractions import Fraction

from indicata.llm.mixing import mix, source_targets


def corpus(spark, rows=400):
    rng = random.Random(2)
    names = ["a", "B", "b", "c", "é", None]
    out = [(k, " ".join(["w"] * int(rng.paretovariate(1.2) * 3 % 400)), rng.choices(names, [50, 1, 10, 10, 20, 9])[0]) for k in range(rows)]
    return spark.createDataFrame(out, "doc_id long, text string, source string"), out


def targets(sizes, share=Fraction(3, 2), most=2):
    """Excess goes back by weight until no target is above its stop."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] > most * sizes[s] * total]
        if not above:
            return out | {s: left * weight[s] / total for s in open_}
        for s in above:
            out[s] = Fraction(most * sizes[s])
            open_.discard(s)
        left -= sum(out[s] for s in above)
    return out


def test_targets_and_taken_words(spark):
    docs, rows = corpus(spark)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    wanted = targets(sizes)
    found = mix(docs).collect()
    taken = {}
    for r in found:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"] and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - float(wanted[r["source"]])) < 1e-6
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    largest = {s: max(r["size"] for r in found if r["source"] == s) for s in sizes}
    for s, t in wanted.items():
        assert abs(taken[s] - t) <= max(0.02 * float(t), 0.5 * largest[s]), s


def test_reruns_agree(spark):
    docs, _ = corpus(spark, 200)
    read = lambda df: sorted(map(str, df.collect()))
    assert read(mix(docs)) == read(mix(docs.repartition(5)))


def test_longer_documents_are_tilted_more(spark):
    docs, _ = corpus(spark)
    rates = {}
    for r in mix(docs).where("target < 1.9 * source_size and target > 1.1 * source_size").collect():
        rates.setdefault((r["source"], r["size"] > r["source_size"] / 60), []).append(r["copies"])
    for source in {s for s, _ in rates}:
        low, high = rates.get((source, False)), rates.get((source, True))
        if low and high:
            assert sum(high) / len(high) >= sum(low) / len(low)


def test_a_single_empty_source(spark):
    rows = spark.createDataFrame([("s", 0), ("s", 0)], "source string, size long")
    assert [(r["source_size"], r["target"]) for r in source_targets(rows).collect()] == [(0, 0.0)]
