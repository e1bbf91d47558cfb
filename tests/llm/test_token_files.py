import random
import zlib

import numpy as np
import public_tokenizers
from cases import documents
from tokenizers import Tokenizer

from contrail.llm import token_files as t

PATH = public_tokenizers.path("word_bpe_49k.json")


def library(text):
    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_packing_is_a_round_trip():
    generator = np.random.default_rng(1)
    for bits in (1, 3, 8, 13, 16, 17, 31, 32):
        for n in (0, 1, 7, 1000):
            ids = generator.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32)
            packed = t.pack(ids, bits)
            assert len(packed) == -(-n * bits // 8)
            assert (t.unpack(packed, n, bits) == ids).all()
    assert [t.bits_for(v) for v in (1, 2, 3, 49408, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


def test_files_give_random_access(tmp_path):
    generator = np.random.default_rng(2)
    docs = [generator.integers(0, 5000, n).astype("<u4") for n in (3, 0, 70_000, 1, 140_000, 5)]
    writer = t.Writer(f"file://{tmp_path}/one.ids", 13)
    for i, ids in enumerate(docs):
        writer.add(None if i == 1 else i * 10, ids)
    writer.close()
    reader = t.Reader(f"file://{tmp_path}/one.ids")
    assert reader.doc_ids == [0, None, 20, 30, 40, 50]
    for i in random.Random(1).sample(range(len(docs)), len(docs)):
        assert (reader.document(i) == docs[i]).all()
    assert [p.name for p in tmp_path.iterdir()] == ["one.ids"]
    assert (tmp_path / "one.ids").stat().st_size < sum(map(len, docs)) * 13 / 8 + 400


def test_encoder_gives_the_library_s_ids(spark):
    generator, tokenizer, encode = random.Random(3), Tokenizer.from_file(PATH), t.encoder(PATH)
    texts = ["don't stop's I'LL", "<|endoftext|> x<|startoftext|>. <|ENDOFTEXT|>", "", "###. ab.. a.b, 1.5. ½. İ. ǅ.", "x" * 5000]
    alphabet = "abAB .,;:!?'\"-%<|>1é É́İıßſœǆ\n\t\x0b\x1d\xa0ªº½Ωж日‍"
    texts += ["".join(generator.choice(alphabet) for _ in range(generator.randrange(40))) for _ in range(4000)]
    for text in texts:
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_table_matches_the_library(spark):
    rows = [(7, "Seven words, é und ß. THE end!", "en", "s"), (3, None, "en", "s"), (-5, "", "en", "s")]
    rows += [(None, "no id", "en", "s"), (9, "b", "en", "s"), (9, "a", "en", "s"), (10, "long word " * 60_000, "en", "s")]
    found = t.token_table(documents(spark, rows)).orderBy("start", "n_tokens").collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for row, (doc_id, text, *_) in zip(found, ordered, strict=True):
        ids = np.array([*library(text or ""), 2], "<u4")
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc_id, start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(ids.tobytes())
        start += len(ids)


def test_hot_ids_are_dealt_over_shards(spark, tmp_path):
    rows = [(None, f"text {i}", "en", "s") for i in range(600)] + [(i, "own id", "en", "s") for i in range(300)]
    rows += [(7, "the same row", "en", "s")] * 900
    manifest = t.write_token_files(documents(spark, rows), f"file://{tmp_path}", PATH)
    sizes = [r["n_docs"] for r in manifest.orderBy("shard").collect()]
    assert sum(sizes) == len(rows)
    assert max(sizes) < 3 * len(rows) / (t.SHARDS * int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = t.read_token_files(manifest).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    assert sum(r["n_tokens"] for r in found[:600]) == sum(len(library(r[1])) + 1 for r in rows[:600])
    same = {(r["n_tokens"], r["ids_crc32"]) for r in found if r["doc_id"] == 7}
    assert len(same) == 2


def test_edges_keep_the_order():
    generator = random.Random(4)
    keys = sorted((True, generator.randrange(9), "", generator.randrange(3)) for _ in range(500))
    deal = t.Dealer([keys[i] for i in range(25, 500, 25)])
    shards = {}
    for key in keys:
        shards.setdefault(deal(key), []).append(key)
    assert sum((shards[i] for i in sorted(shards)), []) == keys
    assert max(map(len, shards.values())) <= 60


def test_empty_table(spark):
    assert t.token_table(documents(spark, [])).count() == 0
