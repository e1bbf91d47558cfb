import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from cases import ASCII_LOWER, documents
from conftest import SF_DIR

from contrail.llm import spelling as sp
from contrail.llm.common import stored


def counted(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(rows):
    """(word, form, root, n, n_near, form_n) by comparing all words with all."""
    counts = counted(rows)
    near, by_length = defaultdict(list), defaultdict(list)
    for w in counts:
        by_length[len(w)].append(w)
    for w in counts:
        near[w] = [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if one_edit(w, v)]
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out)


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def found(spark, rows, **more):
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    words = stored(sp.word_counts(docs), "words")
    return sorted(map(tuple, sp.spelling_variants(words, **more).select(*COLUMNS).collect()))


def sample():
    generator, rows = random.Random(12), []
    stems = ["".join(generator.choice("abéß×÷ÿÀz") for _ in range(generator.randrange(6, 12))) for _ in range(60)]
    for i in range(300):
        words = []
        for _ in range(40):
            w = generator.choice(stems[: 1 + generator.randrange(60)])
            for _ in range(generator.choice([0, 0, 0, 0, 0, 1, 1, 2])):
                at = generator.randrange(len(w))
                w = w[:at] + generator.choice(["", "a", "b", w[at] + "z"]) + w[at + 1 :]
            words.append(w.upper() if generator.random() < 0.1 else w)
        rows.append((i, generator.choice([" ", "-", "1", "\n"]).join(words)))
    long = "x" * 90
    rows += [(1, f"{long} " * 30), (2, f"{long}y {long}y"), (None, "withoutid withoutid"), (None, None), (9, "")]
    return rows + rows[:5]


def test_matches_comparing_all_words(spark):
    rows = sample()
    assert found(spark, rows) == expected(rows)


def test_rounds_of_small_filters_lose_nothing(spark):
    rows = sample()
    assert len(sp._rounds(Counter(len(w) for w in counted(rows)), 8)) > 3
    assert found(spark, rows, filter_bytes=64) == expected(rows)


def test_given_documents(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    result = sp.op12_spelling(spark, SF_DIR).select(*COLUMNS).collect()
    assert sorted(map(tuple, result)) == expected(rows)


def test_chains_are_followed_to_their_end(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(13)] + [("a", "w5"), ("b", "c")]
    ends = dict(map(tuple, sp.roots(spark.createDataFrame(forms, "word string, form string")).collect()))
    assert ends == {f"w{i}": "w13" for i in range(13)} | {"a": "w13", "b": "c"}


def test_edits_have_the_hashes_of_their_words():
    def hash_of(word):
        return sp.hashes_of(np.array([[ord(c) for c in word]], np.uint64))[0]

    words = ["aabbab", "bababa"]
    letters = np.array([[ord(c) for c in w] for w in words], np.uint64)
    made = set()
    for length, letter, word, place, hashes in sp.edits(letters, [97, 98, 99]):
        for w, at, h in zip(word, place, hashes):
            edit = words[w][:at] + ("" if letter is None else chr(letter)) + words[w][at + 1 :]
            assert len(edit) == length and hash_of(edit) == h
            made.add((w, edit))
    assert len(made) == 4 + 6 + sum(w.count("a") * 2 + w.count("b") for w in words)


def test_slices_end_between_words(monkeypatch):
    text = " ".join(f"wordnumber{chr(97 + i % 26)}x" for i in range(200))
    whole = sp.words_of(3, text)
    monkeypatch.setattr(sp, "SLICE", 7)
    assert sp.words_of(3, text) == whole


def test_words_sent_early_add_up(spark, monkeypatch):
    rows = sample()
    monkeypatch.setattr(sp, "TASK_WORDS", 10)
    assert found(spark, rows) == expected(rows)


def test_empty_table(spark):
    assert found(spark, []) == []
