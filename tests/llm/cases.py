"""Small inputs that every operator must take, and brute-force versions of what operators compute."""

import re
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
# Names that operators use inside.
CLASHING = ["row", "key", "size", "node", "score", "words", "kept", "rank", "_id", "_text", "text_hash", "copies", "n"]
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{c} string" for c in CLASHING
)


def documents(spark, rows):
    """Documents from (doc_id, text, lang, source), with further columns of clashing names."""
    full = [(i, t, la, s, None if t is None else len(t), *CLASHING) for i, t, la, s in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def words(text):
    return WORD.findall((text or "").translate(ASCII_LOWER))


def shingles(text, width=5):
    w = words(text)
    if len(w) < width:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def classes(nodes, links):
    """The smallest node reachable from each."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def near_documents(texts):
    """(shingles, component) of each id of ``texts``."""
    sets = {i: shingles(t) for i, t in texts.items()}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {p for ids in holders.values() for p in combinations(sorted(ids), 2)}
    links = [
        (a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    component = classes(sets, links)
    return {i: (len(sets[i]), component[i]) for i in sets}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
