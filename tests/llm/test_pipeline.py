"""The stages one after the other against brute force, on a small fixture."""

import zlib

import numpy as np
import public_tokenizers
from cases import documents as odd_documents, near_documents, words
from conftest import SF_DIR
from tokenizers import Tokenizer

import corpus_pipeline
from contrail.llm.common import documents, stored


def test_stages_in_their_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "MinHash near-dedup", "benchmark decontamination", "mixing to target weights",
        "token-ID binary output",
    ]


def test_each_stage_works_on_what_the_one_before_kept(spark):
    docs = documents(spark, SF_DIR)
    seen = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name.replace(" ", "-"))
        seen.append(docs.collect())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == documents(spark, SF_DIR).columns
    given, known, single, clean, mixture, tokens = seen
    assert {r["doc_id"] for r in known} == {r["doc_id"] for r in given}  # every given text has letters

    component = near_documents({r["doc_id"]: r["text"] for r in known})
    assert {r["doc_id"] for r in single} == {i for i, (_, c) in component.items() if c == i}

    items = [words(r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    runs = {tuple(w[i : i + 14]) for w in items for i in range(len(w) - 13)}
    leaked = {r["doc_id"] for r in single if any(tuple(w[i : i + 14]) in runs for w in [words(r["text"])] for i in range(len(w)))}
    dropped = {r["doc_id"] for r in single} - {r["doc_id"] for r in clean}
    assert leaked and leaked <= dropped and len(dropped) <= 1.3 * len(leaked)

    assert {tuple(r) for r in mixture} <= {tuple(r) for r in clean}
    size = sum(len(words(r["text"])) for r in clean)
    assert abs(sum(len(words(r["text"])) for r in mixture) - size) < 0.03 * size

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for r in sorted(mixture, key=lambda r: (r["doc_id"], r["text"])):
        ids = np.array([*tokenizer.encode(r["text"], add_special_tokens=False).ids, 2], "<u4")
        want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in tokens) == want


def test_odd_rows_pass_all_stages(spark, tmp_path):
    texts = [r["text"] for r in documents(spark, SF_DIR).limit(12).collect()]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(0, texts[0], "en", "s")] * 2
    rows += [(50, None, "en", "s"), (51, "", "en", "s"), (52, "1 2 3", None, None), (None, texts[1], None, "s")]
    odd_documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark, str(tmp_path))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stored(stage(spark, docs, str(tmp_path)), name.replace(" ", "-"))
        assert docs.columns == columns
        assert {r["text"] for r in docs.select("text").collect()} <= set(texts)
        assert docs.count() > 0
    tokens = corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path))
    assert tokens.count() == docs.count()
