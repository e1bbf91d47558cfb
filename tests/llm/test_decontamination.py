import random
from itertools import product

from cases import documents

from contrail.llm import decontamination as d

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()
ODD = "benchmark string, item_id long, text string, place string, hash string"


def test_masks_meet_every_pair_within_the_threshold():
    places = range(d.WINDOW)
    for one, two in product(places, places):
        assert any(one not in kept and two not in kept for _, kept in d.masks([]))


def test_overlaps_and_edge_cases(spark):
    generator = random.Random(1)
    filler = [f"w{i}" for i in range(400)]
    pad = lambda n: [generator.choice(filler) for _ in range(n)]
    changed = list(ITEM)
    changed[3], changed[10] = "other", "thing"
    spoiled = [w if i % 4 else "no" for i, w in enumerate(ITEM)]
    rows = [
        (0, " ".join(pad(50) + ITEM + pad(50)), "en", "a"),
        (1, " ".join(pad(30) + changed + pad(5)).upper(), "en", "a"),  # two of twelve words changed
        (2, " ".join(pad(30) + spoiled + pad(5)), "en", "a"),  # three of twelve: clean
        (3, " ".join(pad(100)), "en", "a"),
        (4, " ".join(ITEM[:11]), "en", "a"),  # less than a window
        (5, "Short items, are found whole!", "en", None),
        (6, None, None, None),
        (7, "", "en", "a"),
        (8, "x" * 3_000_000 + " " + ", ".join(ITEM) + "\n" + "y" * 10, "en", "a"),
        (None, " ".join(ITEM), "en", "a"),
        (None, "clean", "en", "a"),
        (9, " ".join(ITEM), "en", "a"),
        (9, " ".join(ITEM), "en", "a"),  # repeated
        (9, "clean words here", "en", "a"),  # same id, other text
    ]
    docs = documents(spark, rows)
    items = [("b", 2, " ".join(ITEM), "p", "h"), ("b", 3, " ".join(ITEM), "p", "h"), ("b", 4, None, "p", "h")]
    items += [("b", 5, "short items are found whole", "p", "h"), ("b", 6, "clean", "p", "h"), ("b", None, "", "p", "h")]
    benchmark = spark.createDataFrame(items, ODD)
    found = d.contamination(docs, benchmark).collect()
    assert len(found) == len(rows)
    hit = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["longest"], r["item_id"]) for r in found if r["contaminated"])
    assert hit == [
        (False, 0, 18, 2), (False, 1, 18, 2), (False, 5, 5, 5), (False, 8, 18, 2),
        (False, 9, 18, 2), (False, 9, 18, 2), (True, 0, 18, 2),
    ]
    kept = d.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [
        (False, 2), (False, 3), (False, 4), (False, 6), (False, 7), (False, 9), (True, 0),
    ]


def test_items_that_share_windows_have_overlaps_each(spark, monkeypatch):
    monkeypatch.setattr(d, "PIECE", 2)
    own = [f"own{i}" for i in range(40)]
    begins = own[:21] + [f"three{i}" for i in range(15)]
    chorus = [f"chorus{i}" for i in range(14)]
    sung = chorus + [f"verse{i}" for i in range(20)] + chorus  # holds its first windows twice
    texts = {7: own, 3: begins, 8: sung, 9: "short items are found whole".split(), 4: "short items are found whole".split()}
    benchmark = spark.createDataFrame([("b", i, " ".join(w), "p", "h") for i, w in texts.items()], ODD)
    pad = [f"pad{i}" for i in range(30)]
    rows = [(0, pad + own + pad), (1, pad + chorus), (2, pad + texts[4]), (5, pad)]
    docs = documents(spark, [(i, " ".join(w), "en", "s") for i, w in rows])
    found = {(r["doc_id"], r["item_id"], r["start"], r["end"], r["windows"]) for r in d.overlaps(docs, benchmark).collect()}
    # Up to two words beyond a shared passage count as substituted.
    assert found >= {(0, 7, 30, 70, 29), (2, 4, 30, 35, 1), (2, 9, 30, 35, 1)}
    assert {x[:2] for x in found} == {(0, 7), (0, 3), (1, 8), (2, 4), (2, 9)}
    assert sum(x[0] == 1 for x in found) == 2  # one for each place of the chorus
    whole = {r["doc_id"]: (r["overlaps"], r["longest"], r["item_id"]) for r in d.contamination(docs, benchmark).collect()}
    assert whole[0] == (2, 40, 7) and whole[1][0] == 2 and whole[2] == (2, 5, 4) and whole[5] == (0, 0, None)


def test_empty_tables(spark):
    docs, benchmark = documents(spark, []), spark.createDataFrame([], ODD)
    assert d.contamination(docs, benchmark).count() == 0
    clean = d.contamination(documents(spark, [(1, "a b c", "en", "s")]), benchmark).collect()
    assert [(r["doc_id"], r["contaminated"]) for r in clean] == [(1, False)]
