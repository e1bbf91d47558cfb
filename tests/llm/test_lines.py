import random
from hashlib import md5
from itertools import combinations

import pytest
from cases import classes, distance, documents
from pyspark.sql import functions as F

from contrail.llm import lines


def edited(generator, text, most):
    text = list(text)
    for _ in range(generator.randrange(most + 1)):
        at, kind = generator.randrange(len(text)), generator.randrange(3)
        if kind == 0:
            text[at] = generator.choice("abcé ")
        elif kind == 1:
            text.insert(at, generator.choice("abcé "))
        elif len(text) > 10:
            text.pop(at)
    return "".join(text)


def test_bit_parallel_distance(spark):
    generator = random.Random(1)
    rows = []
    for _ in range(1500):
        text = "".join(generator.choice("abé") for _ in range(generator.randrange(10, 40)))
        rows.append((text, edited(generator, text, 4)))
    pairs = spark.createDataFrame(rows, "one string, other string")
    found = pairs.select("one", "other", lines.within_edits(F.col("one"), F.col("other")).alias("near")).collect()
    assert [r["near"] for r in found] == [distance(r["one"], r["other"]) <= lines.EDITS for r in found]


def test_links_match_brute_force(spark):
    generator = random.Random(2)
    bases = ["".join(generator.choice("abcdé ") for _ in range(generator.randrange(10, 60))) for _ in range(25)]
    pool = [edited(generator, b, 5) for b in bases for _ in range(6)] + ["common line of all"] * 3
    rows = []
    for i in range(60):
        some = [generator.choice(pool) for _ in range(5)] + ["common line of all"] * (i % 3 == 0)
        rows.append((i, "\n".join(some), "en", "s"))
    rows += [(100, None, "en", "s"), (101, "", "en", "s"), (102, "\n\nshort\nshirt\n", "en", "s")]
    rows += [(None, "no id has this line\nshort", "en", "s"), (103, "y" * 300_000 + "\n" + "y" * 300_001, "en", "s")]
    rows += [(104, "twice the same row", "en", "s")] * 2
    held, first = {}, {}
    for i, text, *_ in rows:
        for line in {x for x in (text or "").split("\n") if x}:
            held[line] = held.get(line, 0) + 1
            first[line] = min(x for x in (first.get(line), i) if x is not None) if (first.get(line), i) != (None, None) else None
    name = {line: md5(line.encode()).hexdigest() for line in held}
    long = [x for x in held if len(x) >= lines.SHORTEST]
    near = [
        (a, b) for a, b in combinations(long, 2)
        if abs(len(a) - len(b)) <= 2 and (len(a) < 1000 and distance(a, b) <= 2 or len(a) > 1000)
    ]
    assert len(near) > 50
    component = classes(name.values(), [(name[a], name[b]) for a, b in near])
    links = {line: sum(line in p for p in near) for line in held}
    found = lines.near_lines(documents(spark, rows)).collect()
    got = {r["digest"]: (r["doc_id"], r["n_docs"], r["n_links"], r["component"], r["kept"]) for r in found}
    assert len(found) == len(held)
    assert got == {
        name[x]: (first[x], held[x], links[x], component[name[x]], component[name[x]] == name[x]) for x in held
    }


def test_every_place_of_a_line_is_marked(spark):
    passage, near = "a passage that all have", "a passage that all hive"
    keeps = min([passage, near], key=lambda x: md5(x.encode()).hexdigest())
    texts = {i: f"{md5(str(i).encode()).hexdigest()} alone\n\n{passage}" for i in range(3, 40)}
    texts |= {40: f"{passage}\nbetween {'x' * 20}\n{passage}", 2: f"{near}\nshort\nshort", 1: f"{passage}\n{near}\n"}
    rows = [(i, t, "en", "s") for i, t in texts.items()] + [(None, passage, "en", "s"), (50, None, "en", "s")]
    rows += [(60, "equal rows with this", "en", "s")] * 2 + [(61, "", "en", "s")]
    docs = documents(spark, rows)
    found = lines.line_places(docs).collect()
    held = [(i, at, x) for i, t, *_ in rows for at, x in enumerate((t or "").split("\n")) if x]
    same = lambda rows: sorted(rows, key=str)
    digests = [(i, at, md5(x.encode()).hexdigest()) for i, at, x in held]
    assert same((r["doc_id"], r["place"], r["digest"]) for r in found) == same(digests)
    passages = {(r["doc_id"], r["place"]): r["kept"] for r in found if r["component"] == md5(keeps.encode()).hexdigest()}
    assert len(passages) == len(texts) + 3
    assert [at for at, kept in passages.items() if kept] == [(1, [passage, near].index(keeps))]
    component = {r["component"] for r in found}
    assert sum(r["kept"] for r in found) == len(component)

    cut = lines.without_repeats(docs)
    assert cut.columns == docs.columns
    texts_left = {}
    for r in cut.collect():
        texts_left.setdefault(r["doc_id"], []).append(r["text"])
    assert texts_left.pop(60) in (["equal rows with this", ""], ["", "equal rows with this"])
    want = {i: [f"{md5(str(i).encode()).hexdigest()} alone\n"] for i in range(3, 40)}
    want |= {40: [f"between {'x' * 20}"], 2: ["short"], 1: [f"{keeps}\n"], None: [""], 50: [None], 61: [""]}
    assert texts_left == want


def test_null_ids_meet_only_their_own_texts(spark, monkeypatch):
    rows = [(None, f"line number {i} of a row without id\n{md5(str(i).encode()).hexdigest()}", "en", "s") for i in range(200)]
    met = []
    join = lines.join_checked

    def counted(left, right, on, how="inner"):
        joined = join(left, right, on, how)
        if on == ["_id", "_hash"]:
            met.append(joined.count())
        return joined

    monkeypatch.setattr(lines, "join_checked", counted)
    found = lines.near_lines(documents(spark, rows)).collect()
    assert len(found) == 400 and all(r["doc_id"] is None for r in found)
    assert met == [200]  # the numbered lines, which are near each other
    numbered = [r for r in found if r["n_links"]]
    assert len(numbered) == 200 and len({r["component"] for r in numbered}) == 1


@pytest.mark.parametrize("length", range(lines.SHORTEST, 48))
def test_zones_hold_all_that_keys_are_cut_from(length):
    third = length // (lines.EDITS + 1)
    for shorter in range(lines.EDITS + 1):
        n = lines.EDITS + 1
        base, longer = divmod(length - shorter, n)
        for i in range(n):
            start, size = base * i + max(0, longer - (n - i)), base + (i >= n - longer)
            zone = max(0, third * i - 2 * lines.EDITS)
            for shift in range(max(-i, shorter - (lines.EDITS - i)), min(i, shorter + lines.EDITS - i) + 1):
                if start + shift >= 0:
                    assert zone <= start + shift and start + shift + size <= zone + third + 6 * lines.EDITS


def test_empty_table(spark):
    assert lines.near_lines(documents(spark, [])).count() == 0


def test_counts_never_rule_out_a_link(spark):
    generator = random.Random(5)
    letters = lines.COUNTED + lines.MORE + "zé"
    rows = []
    for _ in range(2000):
        line = "".join(generator.choice(letters) for _ in range(generator.randrange(10, 80)))
        other = list(line)
        for _ in range(generator.randrange(lines.EDITS + 1)):
            at, kind = generator.randrange(len(other)), generator.randrange(3)
            other[at : at + (kind != 1)] = [generator.choice(letters)] * (kind != 2)
        rows.append((line, "".join(other)))
    both = spark.createDataFrame(rows, "one string, other string").select(
        "*", *(lines._counts(x, some).alias(x + some[0]) for x in ("one", "other") for some in (lines.COUNTED, lines.MORE))
    )
    allowed = lines._counts_allow(*(("one" + some[0], "other" + some[0]) for some in (lines.COUNTED, lines.MORE)))
    assert both.where(~allowed).count() == 0


def kept_back(monkeypatch):
    """What the operator stores, by purpose."""
    tables, plain = {}, lines.stored

    def stored(df, purpose):
        tables[purpose] = plain(df, purpose)
        return tables[purpose]

    monkeypatch.setattr(lines, "stored", stored)
    return tables


def test_a_family_beyond_the_threshold_lists_few_pairs(spark, monkeypatch):
    generator = random.Random(9)
    base = " ".join("".join(generator.choice("etaoinshr") for _ in range(5)) for _ in range(50))
    family = []
    for _ in range(150):  # with four letters more each, of all letters, so that most pairs are six to eight edits apart
        at = generator.randrange(len(base))
        family.append(base[:at] + "".join(generator.choice("abcdefghiklmnoprstuvw") for _ in range(4)) + base[at:])
    tables = kept_back(monkeypatch)
    found = lines.near_lines(documents(spark, [(i, x, "en", "s") for i, x in enumerate(family)])).collect()
    both = spark.createDataFrame(list(combinations(sorted(set(family)), 2)), "a string, b string")
    assert sum(r["n_links"] for r in found) == 2 * both.where(F.levenshtein("a", "b") <= lines.EDITS).count()
    assert tables["pairs"].count() < 4500  # of 11,175


def test_only_lines_that_repeat_or_link_are_marked(spark, monkeypatch):
    alone = [md5(str(i).encode()).hexdigest() for i in range(100)]
    rows = [(i, f"{x}\na line of all", "en", "s") for i, x in enumerate(alone)] + [(200, "twice here\ntwice here", "en", "s")]
    tables = kept_back(monkeypatch)
    found = lines.line_places(documents(spark, rows)).collect()
    assert len(found) == 202 and sum(r["kept"] for r in found) == 102
    assert tables["marks"].count() == 2
