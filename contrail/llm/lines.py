"""Near-duplicate lines by a segment-partition edit join, with DataFrame functions only.

Lines within ``EDITS`` edits of each other share one of ``EDITS + 1`` segments: the shorter one's segments are
indexed by length and place, the longer one probes the index with the substrings at which such a segment can
stand. Pairs that meet and whose letter counts don't rule it out are verified with a bit-parallel edit distance
over the band of diagonals that ``EDITS`` edits can reach, one machine word for each column.

Equal lines are one line with a count before anything is compared. Only pairs within the threshold leave the
comparison; a line gets its number of links and the class that links make. The classes then go back to every place
at which a line stands, in all documents and repeats included; one place of each class is kept.

Defined cases: null and empty texts have no lines; empty lines are left out; lines under ``SHORTEST`` characters
are compared for equality only, as few edits turn any into any; very long lines are compared whole; rows with a
null id hold lines like others; a line that a document repeats counts once in ``n_docs`` and stands at several
places; rows that repeat a row have places of their own; an empty table gives no row; further columns are ignored,
or kept as they are by ``without_repeats``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from contrail.llm.common import components, documents, join_checked, stored

EDITS, SHORTEST = 2, 10
COUNTED = "eatnoirslhdcump"  # characters whose counts are compared first, two bits each and no sign
MORE = "fgbvywkqxj ,.ET"  # further ones, whose counts are compared before the texts are


def lines_of(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, more, place, line): the distinct lines of each row of ``docs``, in their order."""
    parts = F.array_distinct(F.split("`text`", "\n"))
    found = docs.select(F.col("`doc_id`").alias("doc_id"), *more, F.posexplode(parts).alias("place", "line"))
    return found.where("line <> ''")


def _row_keys() -> list[Column]:
    """Numbers that lead back to a row's text: null ids are told apart by the text, too."""
    known = F.coalesce(F.col("`doc_id`").cast("long"), F.lit((1 << 63) - 1))
    return [known.alias("_id"), F.xxhash64("`text`").alias("_hash")]


def _segment(length: Column, i: int) -> tuple[Column, Column]:
    """(start, size) of the i-th segment of a line, the last ones being the longer ones."""
    n = EDITS + 1
    base, longer = F.floor(length / n).cast("int"), (length % n).cast("int")
    return base * i + F.greatest(F.lit(0), longer - (n - i)), base + (F.lit(i) >= n - longer).cast("int")


def _zone_start(i: int) -> Column:
    return F.greatest(F.lit(0), F.floor(F.col("length") / (EDITS + 1)).cast("int") * i - 2 * EDITS)


def _zones() -> list[Column]:
    """The parts of a line in which its i-th segment, and what a shorter line's can match, stands: cut once each."""
    size = F.floor(F.col("length") / (EDITS + 1)).cast("int") + 6 * EDITS
    return [F.col("line").substr(_zone_start(i) + 1, size).alias(f"zone_{i}") for i in range(EDITS + 1)]


def _key(i: int, length: Column, start: Column, size: Column) -> Column:
    return F.xxhash64(F.lit(i), length, F.col(f"zone_{i}").substr(start - _zone_start(i) + 1, size))


def _index_keys() -> list[Column]:
    length = F.col("length")
    return [F.when(length >= SHORTEST, _key(i, length, *_segment(length, i))) for i in range(EDITS + 1)]


def _probe_keys() -> list[tuple[int, Column]]:
    """(how much shorter, key): where segments of lines as long, or shorter by up to ``EDITS``, can stand in this one.

    With the i-th segment come at most i edits before and ``EDITS - i`` after it, which bounds its shift.
    """
    keys = []
    for shorter in range(EDITS + 1):
        length = F.col("length") - shorter
        for i in range(EDITS + 1):
            start, size = _segment(length, i)
            for shift in range(max(-i, shorter - (EDITS - i)), min(i, shorter + EDITS - i) + 1):
                fits = (length >= SHORTEST) & (start + shift >= 0)
                keys.append((shorter, F.when(fits, _key(i, length, start + shift, size))))
    return keys


def _counts(line: str, letters: str) -> Column:
    """Counts of some characters, modulo 4, in one number; each is one byte, so sizes in bytes give its count.

    A count is a Gray code: the codes of two counts differ in as many bits as the counts are apart, modulo 4.
    """
    total = F.lit(0)
    for i, letter in enumerate(letters):
        n = F.octet_length(line) - F.octet_length(F.replace(F.col(line), F.lit(letter), F.lit("")))
        code = F.call_function("shiftright", F.lit(0b10110100), 2 * n.bitwiseAND(F.lit(3))).bitwiseAND(F.lit(3))
        total = total.bitwiseOR(F.shiftleft(code, 2 * i))
    return total


def _counts_allow(*counts: tuple[str, str]) -> Column:
    """Whether two lines' counts are no further apart than ``EDITS`` make them; an edit changes two by one at most."""
    return sum((F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in counts), F.lit(0)) <= 2 * EDITS


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def within_edits(one: Column, other: Column) -> Column:
    """Whether two texts, neither shorter than ``EDITS``, are within ``EDITS`` edits.

    Bit b of a word stands for row ``column - EDITS + b`` of the table of distances. ``up`` and ``down`` mark
    rows whose distance is one more or less than that of the row above. The distance is followed down the
    lowest diagonal of the band to the last row, and along that row.
    """
    k, width = EDITS, 2 * EDITS + 1
    full = F.lit((1 << width) - 1)

    def matches(a: Column, rows: Column, character: Column, column: Column) -> Column:  # column from 0
        word = F.lit(0)
        for bit in range(width):
            row = column + (bit - k)
            same = (row >= 0) & (row < rows) & (F.get(a, row) == character)
            word = word + F.when(same, 1 << bit).otherwise(0)
        return word

    def step(rows: Column, state: Column, item: Column) -> Column:
        up, down, match, at = state["up"], state["down"], item["match"], item["at"]  # at from 0

        def columns(zero: Column) -> Column:
            plus = down.bitwiseOR(F.bitwise_not(zero.bitwiseOR(up)).bitwiseAND(full))
            minus = zero.bitwiseAND(up)
            last = rows - (at + 1) + k  # the bit of the last row
            bit = lambda word: F.call_function("shiftright", word, last).bitwiseAND(F.lit(1))
            diagonal = 1 - F.shiftright(zero, 2 * k).bitwiseAND(F.lit(1))
            score = state["score"] + F.when(at < rows - k, diagonal).otherwise(bit(plus) - bit(minus))
            return F.struct(zero.alias("zero"), plus.alias("plus"), minus.alias("minus"), score.alias("score"))

        def moved(d: Column) -> Column:
            lower = F.shiftright(d["zero"], 1)
            up = d["minus"].bitwiseOR(F.bitwise_not(lower.bitwiseOR(d["plus"])).bitwiseAND(full))
            return F.struct(up.alias("up"), lower.bitwiseAND(d["plus"]).alias("down"), d["score"].alias("score"))

        same = match.bitwiseAND(up)
        zero = (same + up).bitwiseXOR(up).bitwiseOR(match).bitwiseOR(down).bitwiseAND(full)
        return _let(_let(zero, columns), moved)

    def distance(pair: Column) -> Column:
        a, b, rows = pair["a"], pair["b"], pair["rows"]
        items = F.transform(b, lambda c, at: F.struct(matches(a, rows, c, at).alias("match"), at.alias("at")))
        start = F.struct(F.lit((1 << width) - (1 << k)).alias("up"), F.lit(0).alias("down"), F.lit(k).alias("score"))
        return F.aggregate(items, start, lambda state, item: step(rows, state, item), lambda s: s["score"])

    def same(a: Column, b: Column, most: Column) -> Column:  # at their start
        at = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False).cast("int")
        return F.when(at == 0, most).otherwise(F.least(at - 1, most))

    def ends(pair: Column) -> Column:  # what both begin or end with doesn't count
        a, b, most = pair["a"], pair["b"], F.least(F.size(pair["a"]), F.size(pair["b"])) - k
        return F.struct(a.alias("a"), b.alias("b"), same(a, b, most).alias("start"), most.alias("most"))

    def between(pair: Column) -> Column:
        a, b, start = pair["a"], pair["b"], pair["start"]
        end = same(F.reverse(a), F.reverse(b), pair["most"] - start)

        def cut(end: Column) -> Column:
            parts = [F.slice(c, start + 1, F.size(c) - start - end).alias(name) for c, name in ((a, "a"), (b, "b"))]
            return F.struct(*parts, (F.size(a) - start - end).alias("rows"))

        return _let(end, cut)

    # Characters are split once, not in every step.
    pair = F.struct(F.split(one, "").alias("a"), F.split(other, "").alias("b"))
    near = F.abs(F.length(one) - F.length(other)) <= k
    return F.when(near, _let(_let(_let(pair, ends), between), distance) <= k).otherwise(False)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, line) of the lines in ``wanted`` (node, _id, _hash, place, digest).

    A row of ``docs`` meets only lines of its own text, so no more rows arise than the documents have lines.
    """
    texts = docs.select(*_row_keys(), F.col("`text`").alias("text"))
    found = join_checked(texts, stored(wanted, "wanted"), ["_id", "_hash"])
    line = F.get(F.array_distinct(F.split("text", "\n")), F.col("place"))
    return found.select("node", line.alias("line"), "digest").where("unhex(md5(line)) = digest").select("node", "line").distinct()


def _classed(docs: DataFrame) -> DataFrame:
    """(doc_id, place, digest, n_docs, n_links, name) of each distinct line, digests as bytes; no links, no name."""
    # Lengths and zones are columns of their own, so that they are computed once and not within every key. Keys are
    # cut where texts are read: they, not the lines, are shuffled to find equal lines. The lambda around the place
    # keeps this projection out of whole-stage code, as one method of which it is too long for the JVM to compile.
    found = lines_of(docs, *_row_keys())
    sized = found.select("*", F.length("line").alias("length")).select(*found.columns, "length", *_zones())
    index, probes = _index_keys(), sorted(_probe_keys(), key=lambda x: x[0])
    as_long = sum(shorter == 0 for shorter, _ in probes)
    keys = [f"k{i}" for i in range(len(index) + len(probes))]
    cut = sized.select(
        "doc_id", "_id", "_hash", _let(F.col("place"), lambda place: place).alias("place"),
        F.unhex(F.md5("line")).alias("digest"), _counts("line", COUNTED).alias("counts"),
        *(k.alias(x) for x, k in zip(keys, [*index, *(k for _, k in probes)])),
    )
    one = cut.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.min("_id").alias("_id"), F.min_by("_hash", "_id").alias("_hash"),
        F.min_by("place", "_id").alias("place"), F.count("*").alias("n_docs"), *(F.max(x).alias(x) for x in ["counts", *keys]),
    )
    table = stored(one.select(F.monotonically_increasing_id().alias("node"), *one.columns), "lines")
    index, probes = F.array(*keys[: len(index)]), F.array(*keys[len(index) :])
    # Lines of one length find each other from either side; a number below 0 says that only the smaller one is to.
    probing = F.when(F.col("at") < as_long, -1 - F.col("node")).otherwise(F.col("node"))
    index = table.select(F.explode(index).alias("key"), F.col("node").alias("a"), F.col("counts").alias("_a"))
    probes = table.select(F.posexplode(probes).alias("at", "key"), "node", "counts")
    probes = probes.select("key", probing.alias("b"), F.col("counts").alias("_b"))
    b = F.when(F.col("b") < 0, -1 - F.col("b")).otherwise(F.col("b"))
    once = (F.col("a") < b) | ((F.col("a") != b) & (F.col("b") >= 0))
    met = index.where("key IS NOT NULL").join(
        probes.where("key IS NOT NULL"), (index["key"] == probes["key"]) & once & _counts_allow(("_a", "_b"))
    )
    pairs = stored(met.select(F.least("a", b).alias("a"), F.greatest("a", b).alias("b")).distinct(), "pairs")

    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = _texts(docs, nodes.join(table.select("node", "_id", "_hash", "place", "digest"), "node"))
    texts = stored(texts.select("node", "line", _counts("line", COUNTED).alias("c"), _counts("line", MORE).alias("m")), "texts")
    both = pairs.join(texts.toDF("a", "one", "_a", "_c"), "a").join(texts.toDF("b", "other", "_b", "_d"), "b")
    both = both.where(_counts_allow(("_a", "_b"), ("_c", "_d")))
    links = stored(both.where(within_edits(F.col("one"), F.col("other"))).select("a", "b"), "links")

    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    joined = stored(components(links).join(degree, "node"), "classes")
    names = joined.join(table.select("node", "digest"), "node").groupBy("component").agg(F.min("digest").alias("name"))
    joined = stored(joined.join(names, "component").select("node", "n_links", "name"), "classes")
    rows = join_checked(table.select("node", "doc_id", "place", "digest", "n_docs"), joined, ["node"], "left")
    return rows.select("doc_id", "place", "digest", "n_docs", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "name")


def _shown(digest: str | Column) -> Column:
    return F.lower(F.hex(digest))


def near_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, place, digest, n_docs, n_links, component, kept) of each distinct line of ``docs``.

    ``digest`` is the line's MD5, ``doc_id`` the smallest id of a document with the line and ``place`` the line's
    place among that one's distinct lines; ``n_docs`` rows have the line; ``n_links`` other lines are within
    ``EDITS`` edits; ``component`` is the smallest digest reachable by links; that line is kept. Where the lines
    stand, exact repeats included, is in ``line_places``.
    """
    name = F.coalesce("name", "digest")
    return _classed(docs).select(
        "doc_id", "place", _shown("digest").alias("digest"), "n_docs", "n_links", _shown(name).alias("component"),
        (name == F.col("digest")).alias("kept"),
    )


def _numbered(docs: DataFrame, *more: Column) -> DataFrame:
    """(_row, doc_id, text, more): a number for each row; to be stored before it is used twice."""
    return docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col("`doc_id`").alias("doc_id"), F.col("`text`").alias("text"), *more
    )


def _marked(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """What ``line_places`` gives, and the _row, for ``rows`` (_row, doc_id, text) of ``docs``."""
    classed = _classed(docs).select("digest", "n_docs", "n_links", "name")
    parts = rows.select(
        "_row", "doc_id", F.xxhash64("text").alias("_hash"), F.posexplode(F.split("text", "\n")).alias("place", "line")
    )
    places = parts.where("line <> ''").select("_row", "doc_id", "_hash", "place", F.unhex(F.md5("line")).alias("digest"))
    places = stored(places, "places")
    # Null ids last; the row's number only decides between rows that are equal.
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_hash", "_row", "place")
    first = places.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n_places"))
    # A line that stands at one place and has no link is kept there, and needs no mark.
    table = classed.join(first, "digest").where("n_places > 1 OR n_links > 0")
    table = table.select("digest", "n_docs", "n_links", "name", F.col("first._row").alias("_at"), F.col("first.place").alias("_place"))
    marks = stored(table, "marks")
    # A line that very many rows hold is a hot key of the left side.
    found = join_checked(places, marks, ["digest"], "left")
    name, alone = F.coalesce("name", "digest"), F.col("_at").isNull()
    kept = alone | ((name == F.col("digest")) & (F.col("_row") == F.col("_at")) & (F.col("place") == F.col("_place")))
    return found.select(
        "_row", "doc_id", "place", _shown("digest").alias("digest"), F.coalesce("n_docs", F.lit(1)).cast("long").alias("n_docs"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), _shown(name).alias("component"), kept.alias("kept"),
    )


def line_places(docs: DataFrame) -> DataFrame:
    """(doc_id, place, digest, n_docs, n_links, component, kept) of every line of every row of ``docs``.

    ``place`` counts all lines of the text, from 0, empty ones too. Of each component one place is kept: that of
    the line named by ``component`` in the smallest doc_id, by the smallest hash of the text if rows share the id,
    and first in the text. Other columns are those of ``near_lines``.
    """
    return _marked(docs, _numbered(docs)).drop("_row")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with all their columns, and in ``text`` only kept lines and the empty ones.

    Texts without a line that goes stay as they are; a text of which no line is kept is left with its empty lines.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = stored(_numbered(docs, row).select("_row", "row"), "rows")
    marked = _marked(docs, rows.select("_row", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text")))
    gone = stored(marked.where("NOT kept").groupBy("_row").agg(F.collect_list("place").alias("gone")), "gone")

    def left(parts: Column) -> Column:
        at = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
        return F.array_join(F.transform(at, lambda i: F.get(parts, i)), "\n")

    cut = _let(F.split("row.text", "\n"), left)
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(cut).alias("text")
    found = join_checked(rows, gone, ["_row"], "left")
    return found.select(*(text if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def op5_lines(spark: SparkSession, folder: str) -> DataFrame:
    return line_places(documents(spark, folder))
