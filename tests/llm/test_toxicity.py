import random

import numpy as np
from cases import documents

from contrail.llm import toxicity

LABELS = "doc_id long, quality int, toxic int, score string"


def corpus():
    """Documents of some sentences; one sentence of a toxic one has a bad word."""
    generator = random.Random(1)
    vocabulary = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1200):
        toxic = i % 5 == 1 or i % 7 == 0
        sentences = [[generator.choice(vocabulary) for _ in range(8)] for _ in range(generator.randrange(2, 9))]
        if toxic:
            generator.choice(sentences).insert(3, generator.choice(["vile", "nasty", "Rotten"]))
        rows.append((i, ". ".join(" ".join(s) for s in sentences) + ".", "en", "s"))
        labels.append((i, 1, int(toxic), "x"))
    return rows, labels


def test_held_out_and_offending_sentences(spark):
    rows, labels = corpus()
    docs = documents(spark, rows)
    model = toxicity.learned(docs, spark.createDataFrame([*labels, (5000, 1, 1, "x"), (None, 1, 1, "x"), (3, 1, None, "x")], LABELS))
    odd = [(9000, None, "en", "s"), (9001, "", "en", "s"), (9002, " .!? \n", "en", "s"), (None, "so vile. fine", "en", "s")]
    odd += [(9003, "fine words. " * 50_000 + "you NASTY thing! ok", "en", "s")] + [(9004, "a vile one", "en", "s")] * 2
    found = toxicity.scored(documents(spark, rows + odd), model, with_text=True)
    found = found.select("row.doc_id", "score", "worst", "worst_text", toxicity.held_out("row.doc_id", 5, 0).alias("out"))
    got = found.collect()
    truth = {i: t for i, _, t, _ in labels}
    out = [r for r in got if r["doc_id"] in truth and r["out"]]
    assert len(out) > 150 and np.mean([(r["score"] >= 0.5) == bool(truth[r["doc_id"]]) for r in out]) > 0.98
    for r in got:
        assert 0 <= r["score"] <= 1
        if truth.get(r["doc_id"]):
            assert any(bad in r["worst_text"].lower() for bad in ("vile", "nasty", "rotten"))
    by_id = {r["doc_id"]: r for r in got}
    assert [(by_id[i]["score"], by_id[i]["worst"]) for i in (9000, 9001, 9002)] == [(0, None)] * 3
    assert by_id[None]["worst_text"] == "so vile." and by_id[9003]["worst_text"] == "you NASTY thing!"
    assert by_id[9003]["worst"] == 50_000 and sum(r["doc_id"] == 9004 for r in got) == 2


def test_no_labels_one_kind_and_no_rows(spark):
    docs = documents(spark, [(1, "some text. more", "en", "s"), (2, None, "en", "s")])
    empty = toxicity.learned(docs, spark.createDataFrame([], LABELS))
    assert [0 <= r["score"] < 0.1 for r in toxicity.scored(docs, empty).collect()] == [True, True]
    kind = toxicity.learned(docs, spark.createDataFrame([(1, 1, 1, "x")], LABELS))
    assert {r["row"]["doc_id"]: r["score"] >= 0.5 for r in toxicity.scored(docs, kind).collect()}[1]
    assert toxicity.scored(documents(spark, []), empty).count() == 0


def test_noisy_or_gradient():
    """The step's gradient is that of the documents' likelihood."""
    model = toxicity.Model(np.zeros(toxicity.BUCKETS, np.float32), 0.0)
    none = toxicity._log_none(model, np.array([1, 2, 3]), np.array([0, 1]))
    assert np.allclose(np.exp(none), 0.5)
