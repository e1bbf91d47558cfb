import random

from cases import WORD, documents

from contrail.llm import mixing


def targets(sizes, weights=(5, 2, 1), most=3):
    """Shares by weight, stopping at ``most`` times a source's size, the excess reshared."""
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {s for s in sizes if sizes[s] == 0}
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in sizes if s not in full)
        share = {s: most * sizes[s] if s in full else left * weight[s] / open_ for s in sizes}
        over = {s for s in sizes if s not in full and share[s] >= most * sizes[s]}
        if not over:
            return share
        full |= over


def make(spark):
    generator = random.Random(2)
    rows = []
    for i in range(900):
        source = "hot" if i % 3 == 0 else ["é", "b", "Z", None, "a", "tiny"][min(i % 11, 5) if i % 50 else 5]
        source = "small" if source == "tiny" and i > 60 else source
        rows.append((i, " ".join(["w"] * generator.randrange(0, 200)), "en", source))
    rows += [(901, None, None, "hot"), (902, "", "en", "empty"), (None, "a b c", "en", "hot")]
    rows += [(903, "same text twice", "en", "b")] * 2 + [(904, "x " * 20_000, "en", "hot")]
    return rows, documents(spark, rows)


def test_targets_and_copies(spark):
    rows, docs = make(spark)
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = targets(sizes)
    found = mixing.mix(docs).collect()
    assert sum(r["n"] for r in found) == len(rows)
    taken = {}
    for r in found:
        source = None if r["key"] == "2" else r["key"][1:]
        assert abs(r["target"] - want[source]) < 1e-6 * max(1, want[source])
        assert r["source_size"] == sizes[source] and 0 <= r["copies"] <= 3
        taken[source] = taken.get(source, 0) + r["copies"] * r["size"] * r["n"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(0.02 * target, 20), (source, taken[source], target)


def test_reruns_agree_and_rows_are_repeated(spark):
    rows, docs = make(spark)
    one = sorted((r["key"], r["doc_id"] or -1, r["copies"]) for r in mixing.mix(docs).collect())
    two = sorted((r["key"], r["doc_id"] or -1, r["copies"]) for r in mixing.mix(docs.repartition(7)).collect())
    assert one == two
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    counts = {}
    for r in out.select("doc_id").collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    want = {}
    for r in mixing.mix(docs).collect():
        if r["copies"]:
            want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["copies"] * r["n"]
    assert counts == want


def test_unequal_probabilities(spark):
    """Short documents pull half as much, so about half as many of them are drawn."""
    rows = [(i, " ".join(["w"] * (20 if i % 2 else 60)), "en", "s" if i < 2000 else "t") for i in range(4000)]
    found = mixing.mix(documents(spark, rows), weights=(3.0, 1.0)).where("key = '1t'").collect()
    short = [r["copies"] for r in found if r["size"] == 20]
    long = [r["copies"] for r in found if r["size"] == 60]
    assert 0.4 < (sum(short) / len(short)) / (sum(long) / len(long)) < 0.6


def test_empty_table(spark):
    docs = documents(spark, [])
    assert mixing.mix(docs).count() == 0
    assert mixing.mixed(docs).count() == 0
