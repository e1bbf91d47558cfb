import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from cases import documents
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from contrail.llm import alignment as al

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A, B = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
A.encode_special_tokens = True
SIGNS = {sign: bytes([byte]) for sign, byte in al.byte_level().items()}
ALPHABET = "abAB .,;:!?'\"-%<|>1é É́İıßſœǆ\n\t\x0b\x1d\x00\x85\xa0ªº½Ωж日‍▁😀 　"


def tokens(text):
    """((id, bytes) of A, of B) for a whole text, or two empty lists."""
    a = [(i, b"".join(SIGNS[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    same = b"".join(x for _, x in a) == whole and b"".join(x for _, x in b) == whole
    return (a, b) if text and same else ([], [])


def spans(side):
    at, found = 0, []
    for i, x in side:
        found.append((at, at + len(x), i))
        at += len(x)
    return found


def expected(rows):
    """What ``alignments`` gives for (doc_id, text), by comparing all tokens of a text with all."""
    links, out = [], []
    for doc_id, text in rows:
        a, b = map(spans, tokens(text or ""))
        links.append([(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]])
        ends = sorted({x[1] for x in a} & {y[1] for y in b})
        groups = []
        for first, end in zip([0, *ends], ends):
            sides = (",".join(str(x[2]) for x in side if first <= x[0] < end) for side in (a, b))
            groups.append("|".join(sides))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append([doc_id, len(a), len(b), len(groups), len(links[-1]), digest])
    counts = Counter(pair for one in links for pair in one)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    for row, one in zip(out, links):
        row[5:5] = [sum(counts[p] == best[p[1]] for p in one), sum(counts[p] for p in one)]
    return sorted(map(tuple, out), key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def sample():
    generator = random.Random(11)
    texts = ["".join(generator.choice(ALPHABET) for _ in range(generator.randrange(60))) for _ in range(150)]
    texts += [".", "! a", "\nx", "\n\n", ".a b", "a.b", "a. b", "x\ny", "x\n y", "x \ny", "x.\n\nY!?", "a .b", "\x00.x .x", "...\n.", "don't.'s"]
    texts += ["<|endoftext|> x", "<s> </s> <unk> <0x41>", "aaaa aaa aa a aaaaa", " lead", "trail  ", "a  b   c", "x▁y"]
    return [*enumerate(texts), (5, "again"), (5, "again"), (None, "no id"), (None, "nor here"), (900, None), (901, "")]


@pytest.mark.parametrize("hot", [al.HOT_PAIRS, 40, 0])
def test_matches_comparing_all_tokens(spark, hot):
    rows = sample()
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    found = al.alignments(docs, A_PATH, B_PATH, hot_pairs=hot).select(*COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows)


def test_pieces_encode_as_the_whole_text():
    align, generator = al.Aligner(A_PATH, B_PATH), random.Random(12)
    for _ in range(3000):
        text = "".join(generator.choice(ALPHABET) for _ in range(generator.randrange(1, 50)))
        a, b = tokens(text)
        sizes, digest, regular, irregular = align(text)
        assert sizes[:2] == [len(a), len(b)]
        assert sizes[3] == sum(regular[1]) + sum(irregular[1])


def test_slices_and_a_forgetful_cache_change_nothing(monkeypatch):
    align, generator = al.Aligner(A_PATH, B_PATH), random.Random(13)
    letters = "".join(generator.choice("abcdefgh ,.\n") for _ in range(4000))
    long = f"{letters} {'x' * 500} {'long word ' * 300}"
    whole = align(long)
    monkeypatch.setattr(al, "SLICE", 50)
    monkeypatch.setattr(al, "CACHED", 40)
    cut = al.Aligner(A_PATH, B_PATH)(long)
    assert whole[:2] == cut[:2]
    for one, other in zip(whole[2:], cut[2:]):
        assert all((x == y).all() for x, y in zip(one, other))


def test_totals_sent_early_add_up(spark, monkeypatch):
    rows = [(i, f"word{i} dess{i % 7}ert, Zwölf {i}") for i in range(600)]
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows]).coalesce(1)
    monkeypatch.setattr(al, "TASK_PAIRS", 5)
    found = al.alignments(docs, A_PATH, B_PATH).select(*COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows)


def test_empty_table(spark):
    assert al.alignments(documents(spark, []), A_PATH, B_PATH).count() == 0
