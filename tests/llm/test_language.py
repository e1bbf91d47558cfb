import random

from cases import documents
from conftest import SF_DIR

from contrail.llm import language


def sample(spark):
    docs = spark.read.parquet(SF_DIR.replace("0.001", "0.01") + "/documents.parquet")
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]


def test_held_out_accuracy_and_mixtures(spark):
    rows = sample(spark)
    model = language.learned(documents(spark, rows))
    assert model.languages == ["de", "en", "es", "fr"]
    found = language.identified(documents(spark, rows), model, keep=["doc_id"])
    lang = {i: la for i, _, la, _ in rows}
    scored = found.select("row.doc_id", "lang_pred", "score", language.held_out("row.doc_id", 3, 1).alias("out")).collect()
    out = [r for r in scored if r["out"]]
    assert len(out) > 250 and sum(r["lang_pred"] == lang[r["doc_id"]] for r in out) >= 0.99 * len(out)
    assert all(0 <= r["score"] <= 1 for r in scored)

    by_lang = {}
    for _, text, la, _ in rows:
        if len(text) > 3000:
            by_lang.setdefault(la, text[:3000])
    half = by_lang["de"] + "\n" + by_lang["fr"]
    odd = [(0, half, None, None), (1, by_lang["en"], None, None), (2, None, None, None), (3, "", "en", "s")]
    odd += [(4, "12 34 !? 5", "en", "s"), (5, "e", "de", "s"), (None, by_lang["es"], "es", "s")]
    odd += [(6, (by_lang["fr"] + " ") * 1000, "fr", "s")] + [(7, by_lang["en"], "en", "s")] * 2
    docs = documents(spark, odd)
    found = language.identified(docs, model).collect()
    got = [(r["row"]["doc_id"], r["lang_pred"], round(r["score"], 2), r["languages"]) for r in found]
    assert set(got[0][3]) == {"de", "fr"} and abs(got[0][3]["de"] - 0.5) < 0.1
    assert [g[1] for g in got[1:]] == ["en", "und", "und", "und", "en", "es", "fr", "en", "en"]
    assert got[1][2] > 0.95 and got[2][2] == got[3][2] == got[4][2] == 0
    assert found[1]["row"].asDict().keys() == dict.fromkeys(docs.columns).keys()


def test_sets_have_any_size_and_all_languages_are_tried(spark, monkeypatch):
    rows = sample(spark)
    by_lang = {}
    for i, text, la, _ in rows:
        if len(text) > 3000:
            by_lang.setdefault(la, text[:3000])
    model = language.learned(documents(spark, rows))
    text = "\n".join(by_lang[la] for la in ("de", "en", "es", "fr"))
    found = language.identified(documents(spark, [(0, text, None, None)]), model).first()["languages"]
    assert set(found) == {"de", "en", "es", "fr"} and all(abs(x - 0.25) < 0.1 for x in found.values())

    # Nine relatives of each other, and one language of its own letters.
    generator = random.Random(5)
    coin = lambda letters: "".join(generator.choice(letters) for _ in range(generator.randrange(4, 9)))
    latin = [coin("abcdefghijklmnop") for _ in range(300)]
    words = {f"r{k}": latin[:270] + [coin("abcdefghijklmnop") for _ in range(60)] for k in range(9)}
    words["el"] = [coin("αβγδεζηθικλμ") for _ in range(300)]
    said = lambda la, n: " ".join(generator.choice(words[la]) for _ in range(n))
    rows = [(i * 10 + k, said(la, 200), la, "s") for k, la in enumerate(words) for i in range(30)]
    model = language.train(documents(spark, rows))
    monkeypatch.setattr(language, "CELLS", 1)  # each text is looked at by itself
    text = f"{said('r4', 950)} {said('el', 40)}"
    found = language.identified(documents(spark, [(0, text, None, None), (1, said("r7", 300), None, None)]), model)
    one, other = sorted(found.collect(), key=lambda r: r["row"]["doc_id"])
    assert one["lang_pred"] == "r4" and 0.01 < one["languages"]["el"] < 0.15
    assert other["lang_pred"] == "r7" and "el" not in other["languages"]


def test_without_labels_or_rows(spark):
    docs = documents(spark, [(1, "some text", None, "s"), (2, None, None, None)])
    model = language.learned(docs)
    assert model.languages == []
    assert [r["lang_pred"] for r in language.identified(docs, model).collect()] == ["und", "und"]
    assert language.with_known_language(documents(spark, [])).count() == 0


def test_stage_keeps_texts_in_a_language(spark):
    rows = sample(spark)[:60] + [(5000, "123 456", None, "s"), (5001, None, None, None)]
    docs = documents(spark, rows)
    kept = language.with_known_language(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in rows[:60]}
