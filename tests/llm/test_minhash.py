import random

import numpy as np
from cases import documents, near_documents, shingles
from conftest import SF_DIR
from pyspark.sql import functions as F

from contrail.llm import minhash


def variants(generator):
    """Texts of which some are near each other, at similarities on both sides of the threshold."""
    vocabulary = [f"w{i}" for i in range(500)]
    texts, n = {}, 0
    for _ in range(12):
        base = [generator.choice(vocabulary) for _ in range(generator.randrange(40, 120))]
        for _ in range(12):
            copy = list(base)
            for _ in range(generator.randrange(0, 6)):
                copy[generator.randrange(len(copy))] = generator.choice(vocabulary)
            texts[n] = " ".join(copy)
            n += 1
    return texts


def test_components_match_brute_force(spark):
    texts = variants(random.Random(3))
    edge = {
        900: None, 901: "", 902: " \t\n", 903: "Only four words here", 904: "only FOUR words\nhere", 905: "only four words",
        906: "one two three four five", 907: "é É ü", 908: "É é ü", 909: "a " * 200_000, 910: "a " * 150_000,
    }
    texts |= edge
    rows = [(i, t, "en", "s") for i, t in texts.items()]
    want = near_documents(texts)
    docs = documents(spark, rows)
    found = minhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, c) in want.items() if c == i}


def test_given_documents_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = near_documents({r["doc_id"]: r["text"] for r in docs.collect()})
    found = minhash.op6_minhash(spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f", "en", "s"), (None, "a b c d e f", "en", "s"), (5, "q r s t u v", "en", "s")]
    rows += [(5, "q r s t u v", "en", "s"), (None, "q r s t u v", "en", "s"), (6, "x", "en", "s"), (6, "y", "en", "s")]
    docs = documents(spark, rows)
    found = minhash.near_duplicates(docs).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in found) == [
        ("5", "5", True), ("5", "5", True), ("6", "6", True), ("6", "6", True),
        ("None", "5", False), ("None", "None", True), ("None", "None", True),
    ]
    assert sorted(str(r["doc_id"]) for r in minhash.deduplicated(docs).collect()) == ["5", "6", "6", "None"]


def test_linked_texts_under_equal_and_null_ids(spark):
    generator = random.Random(8)
    base = lambda: [f"w{generator.randrange(10**6)}" for _ in range(80)]

    def near(words, at):
        return " ".join(w if i != at else "other" for i, w in enumerate(words))

    a, b, c, d, e = (base() for _ in range(5))
    rows = [
        (3, " ".join(a)), (6, near(a, 79)), (6, " ".join(b)),  # of id 6 one text is near 3, the other stands alone
        (7, " ".join(c)), (7, near(c, 79)), (8, near(c, 0)),  # near texts under one id
        (None, near(b, 79)), (None, near(a, 0)),  # near rows with ids
        (None, " ".join(d)), (None, near(d, 79)), (None, near(d, 0)), (None, " ".join(e)),  # near among themselves
    ]
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    found = minhash.near_duplicates(docs).join(docs.selectExpr("xxhash64(text) AS text_hash", "text"), "text_hash").collect()
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    got = {(r["doc_id"], r["text"]): (r["component_id"], r["stays"]) for r in found}
    assert {i: c for (i, t), (c, _) in got.items() if i == 3 or t == near(a, 79)} == {3: 3, 6: 3}
    assert [got[row][0] for row in rows] == [3, 3, 6, 7, 7, 7, 6, 3, None, None, None, None]
    kept = [got[row][1] for row in rows]
    assert kept[:3] == [True, False, True] and sum(kept[3:5]) == 1 and not any(kept[5:8])
    assert sum(kept[8:11]) == 1 and kept[11]
    left = minhash.deduplicated(docs).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in left) == sorted((str(i), t) for (i, t), k in zip(rows, kept) if k)


def test_empty_table(spark):
    assert minhash.near_duplicates(documents(spark, [])).count() == 0
    assert minhash.deduplicated(documents(spark, [])).count() == 0


def test_sketches_keep_every_pair_that_may_link():
    lines = minhash._most_differing()
    generator = np.random.default_rng(5)
    for size in (4, 20, 150, 600, 3000, 20_000):
        for _ in range(30):
            both = generator.integers(1, 2**63, size, dtype=np.uint64)
            more = generator.integers(1, 2**63, size // 3, dtype=np.uint64)  # the least similarity that links
            at = generator.integers(0, len(more) + 1)
            one, two = np.concatenate([both, more[:at]]), np.concatenate([both, more[at:]])
            differing = int(np.bitwise_count((minhash.sketch(one) ^ minhash.sketch(two)).view(np.uint64)).sum())
            most = (len(one) + len(two)) / 7
            assert differing <= min(slope * most + start + 1e-6 for slope, start in lines)


def test_a_family_below_the_threshold_lists_few_pairs(spark, monkeypatch):
    generator = random.Random(8)
    base, asked = [f"w{i}" for i in range(150)], []
    plain = minhash.confirmed

    def counted(docs, pairs, *more):
        asked.append(pairs.count())
        return plain(docs, pairs, *more)

    texts = {}
    for i in range(120):  # each pair is at a similarity of about 0.55
        copy = list(base)
        for at in generator.sample(range(150), 5):
            copy[at] = f"x{generator.randrange(10**6)}"
        texts[i] = " ".join(copy)
    monkeypatch.setattr(minhash, "confirmed", counted)
    found = minhash.near_duplicates(documents(spark, [(i, t, "en", "s") for i, t in texts.items()])).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == near_documents(texts)
    assert sum(asked) < 800  # of 7,140 pairs


def test_a_pair_of_many_keys_is_met_once(spark):
    rows = [(i, " ".join(f"w{j}" if j != 30 + i else "x" for j in range(400)), "en", "s") for i in range(2)]
    signed = minhash.signatures(documents(spark, rows)).withColumn("node", F.monotonically_increasing_id())
    keys = signed.select("node", "n_shingles", *minhash.SIGNATURE, *minhash.SKETCH, F.posexplode(minhash._keys()).alias("number", "key"))
    one = minhash._sided(keys, "a", "key", "number", *minhash._own("a"), *minhash._earlier())
    met = one.join(minhash._sided(keys, "b", "key", *minhash._own("b")), "key").where("a < b")
    assert met.count() > 10
    assert met.where(minhash._first_choice() & minhash._first_chunk()).count() == 1


def test_compared_pairs_are_not_one_large_method(spark):
    signed = minhash.signatures(documents(spark, [(0, "a b c d e f", "en", "s")])).withColumn("node", F.col("doc_id"))
    pairs = spark.range(1).select(F.col("id").alias("a"), F.col("id").alias("b"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near = minhash._near(pairs, signed)
        assert near.count() == 1
        near.collect()
        plan = near._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    joins = [line.strip(" :+-") for line in plan.split("\n") if "SortMergeJoin" in line and "aggregate(" in line]
    assert len(joins) == 1 and joins[0].startswith("SortMergeJoin")  # a star before it says that it is generated whole


def test_signatures_agree_as_sets_do():
    generator = np.random.default_rng(4)
    one = generator.integers(1, 2**63, 4000, dtype=np.uint64)
    two = np.concatenate([one[:3000], generator.integers(1, 2**63, 500, dtype=np.uint64)])
    same = []
    for i in range(40):
        a, b = np.unique(minhash.mix(one + np.uint64(i))), np.unique(minhash.mix(two + np.uint64(i)))
        longs = (minhash.signature(a) ^ minhash.signature(b)).reshape(minhash.CHUNKS, -1)
        lanes = longs[:, :, None] >> (np.arange(minhash.LANES) * minhash.LANE) & 0x7FFF
        same.append((lanes.reshape(minhash.CHUNKS, -1)[:, : minhash.SYMBOLS // minhash.CHUNKS] == 0).mean())
    assert abs(np.mean(same) - 3000 / 4500) < 0.05


def test_shingles_are_those_of_words():
    texts = ["A b\tc\x0bd e F", "a\x1cb c", "", "ÀB c"]
    import pyarrow as pa

    assert [len(s) for s in minhash.sets_of(pa.array([*texts, None]))] == [len(shingles(t)) for t in [*texts, None]]


def test_the_nearest_pair_of_two_components_goes_first(spark, monkeypatch):
    generator, asked, plain = random.Random(4), [], minhash.confirmed
    words = [f"w{generator.randrange(10**6)}" for _ in range(400)]
    texts = {i: " ".join(words[3 * i : 3 * i + 150]) for i in range(80)}  # each near those up to six places away

    def counted(docs, pairs, *more):
        asked.append(pairs.count())
        return plain(docs, pairs, *more)

    monkeypatch.setattr(minhash, "confirmed", counted)
    found = minhash.near_duplicates(documents(spark, [(i, t, "en", "s") for i, t in texts.items()])).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == near_documents(texts)
    assert sum(asked[1:]) < 100
