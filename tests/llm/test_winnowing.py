import hashlib
import random

import numpy as np
from cases import documents
from conftest import SF_DIR

from contrail.llm import winnowing as wi


def plain(text, gram=wi.GRAM, window=wi.WINDOW):
    """(hash, position) by looking at every window."""
    letters = np.array([ord(c) for c in text], np.uint64)
    if not len(letters):
        return []
    width = min(gram, len(letters))
    hashes = [int(wi.grams(letters[i : i + width])[0]) for i in range(len(letters) - width + 1)]
    kept = set()
    for first in range(max(1, len(hashes) - window + 1)):
        part = hashes[first : first + window]
        kept.add(first + max(range(len(part)), key=lambda i: (-(part[i] >> 24), i)))
    return [(hashes[i], i) for i in sorted(kept)]


def pairs(fingerprint):
    return [(int(h), int(p)) for h, p in zip(*fingerprint)]


def texts():
    generator = random.Random(13)
    found = ["", "a", "ab" * 200, "x" * 1000, "é😀" * 90]
    return found + ["".join(generator.choice("ab c") for _ in range(generator.randrange(400))) for _ in range(60)]


def test_every_window_keeps_its_least_hash():
    for text in texts():
        assert pairs(wi.winnow(text)) == plain(text)


def test_slices_change_nothing(monkeypatch):
    whole = [pairs(wi.winnow(t)) for t in texts()]
    monkeypatch.setattr(wi, "SLICE", 37)
    assert [pairs(wi.winnow(t)) for t in texts()] == whole


def test_shared_passages_share_a_hash_at_matching_places():
    generator = random.Random(14)
    letters = "abcdefghij "
    for _ in range(200):
        passage = "".join(generator.choice(letters) for _ in range(wi.WINDOW + wi.GRAM - 1))
        ends = ["".join(generator.choice(letters) for _ in range(generator.randrange(300))) for _ in range(4)]
        one, other = ends[0] + passage + ends[1], ends[2] + passage + ends[3]
        a, b = dict(pairs(wi.winnow(one))), pairs(wi.winnow(other))
        assert any(a.get(h) == p - len(ends[2]) + len(ends[0]) for h, p in b)


def order(row):
    return row[0] is None, -(row[0] or 0)


def check(spark, rows, docs, ties=False):
    found = [tuple(r) for r in wi.compared(docs).collect()]
    if ties:  # rows of one id stand in the order of a hash; only what doesn't depend on it is compared
        assert sorted((repr(r[0]), r[1]) for r in found) == sorted((repr(i), len(t or "")) for i, t in rows)
        return found
    ordered = sorted(rows, key=order)
    expected = []
    for (doc_id, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        text, following = text or "", following or ""
        n = len(text) // 3
        changed = text[: len(text) - n] + (following if len(following) < n else following[:n])
        prints = [plain(t) for t in (text, changed, following)]
        sets = [{h for h, _ in p} for p in prints]
        near = [len(sets[0] & s) / len(sets[0] | s) if sets[0] | s else 1.0 for s in sets[1:]]
        shown = [";".join(f"{h:016x}:{p}" for h, p in one) for one in prints[:2]]
        digest = hashlib.sha256(changed.encode()).hexdigest()
        expected.append((doc_id, len(text), digest, *shown, *near))
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    return found


def test_neighbours_over_many_buckets(spark):
    rows = list(enumerate([*texts(), None]))
    rows = [(i - 3, t) for i, t in rows] + [(None, "without an id"), (-(2**63), "least"), (2**63 - 1, "largest")]
    random.Random(1).shuffle(rows)
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    check(spark, rows, docs)
    check(spark, rows, docs.repartition(7))


def test_equal_ids_and_repeated_rows(spark):
    rows = [(1, "a" * 50)] * 40 + [(2, "b" * 40), (2, "c" * 40)] + [(None, f"text {i} " * 9) for i in range(50)]
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    found = check(spark, rows, docs, ties=True)
    assert len({r[3] for r in found if r[0] == 1}) == 1
    assert sum(r[6] == 1.0 for r in found if r[0] == 1) == 39


def test_a_single_row_is_its_own_neighbour(spark):
    row = [(4, "only this text " * 20)]
    check(spark, row, documents(spark, [(4, row[0][1], "en", "s")]))


def test_likeness_of_given_documents(spark):
    found = wi.op13_winnowing(spark, SF_DIR).collect()
    long = [r for r in found if r["n_chars"] > 1000]
    assert sum(0.3 <= r["near_edited"] <= 0.7 for r in long) >= 0.9 * len(long)
    assert sum(r["near_next"] < 0.1 for r in long) >= 0.8 * len(long)


def test_fingerprint_table(spark):
    rows = [(1, "some text that is repeated " * 20), (None, "no id " * 40), (2, None)]
    found = wi.fingerprints(documents(spark, [(i, t, "en", "s") for i, t in rows])).collect()
    expected = [(i, h - (h >> 63 << 64), p) for i, t in rows for h, p in plain(t or "")]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_empty_table(spark):
    assert wi.compared(documents(spark, [])).count() == 0
