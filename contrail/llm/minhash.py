"""Near-duplicate documents by a multi-index Hamming join over b-bit MinHash signatures.

A signature has ``SYMBOLS`` minima of ``BITS`` bits each. It is cut into ``CHUNKS`` chunks; by the pigeonhole
principle two signatures that differ in fewer than ``CHUNKS * (ERRORS + 1)`` symbols have a chunk with at most
``ERRORS`` differences. Which symbols of a chunk may differ is enumerated: every choice of the others is a key,
and such a pair meets in at least one key. At a similarity of 0.75 a pair is missed with probability 1.2e-5,
less above. Links are confirmed on the full shingle sets.

Documents with equal sets are one class with a number of its own, and only classes go on. Pairs within a key are not
listed: first every representative is compared with the nearest and the most central of its keys' leads, which
joins most of a group to stars; only pairs that share a key, are of different components by then, and are within
``FAR`` symbols, are compared one by one. Beside its signature a set has an odd sketch, ``MARKS`` parities of how
many of its shingles fall to a place: two sketches differ in no more places than the sets in shingles, so that pairs
of short texts below the threshold meet no further, without a loss; in long texts places coincide and a margin is left.

Defined cases: null, empty and wordless texts have no shingles and link with nothing; texts of fewer words
than a shingle are one shingle; very long texts are hashed in pieces and compared whole; rows with equal ids are
judged each by its own text, and so are rows with a null id; a component is named by its smallest id, which is null
if it has none, and keeps the row with that id, of several texts the one with the smallest hash; rows that are equal
in id and text are judged alike; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from contrail.llm.common import ROW_KEY, components, documents, join_checked, keyed, lean, row_key, ship, small_batches, stored, unkeyed
from contrail.llm.words import chunks, mix, shingle_set, utf8, word_hashes

WORDS, PERCENT = 5, 75
SYMBOLS, BITS, CHUNKS, ERRORS = 25, 15, 5, 2
FAR = 16  # differing symbols beyond which a pair is not compared; at 0.75 the chance is 5e-6
MARKS, MARGIN = 1024, 6.0  # parities of a sketch; standard deviations beyond which a pair of sketches is not compared
LANES, LANE = 3, 16  # symbols in a long and bits for each, one more than they have
LONGS = -(-SYMBOLS // CHUNKS // LANES)  # of a chunk
SIGNATURE = [f"s{i}" for i in range(CHUNKS * LONGS)]
SKETCH = [f"z{i}" for i in range(MARKS // 64)]
AT_ONCE = 1 << 18  # bytes of texts hashed together, which bounds a Python worker's temporary arrays
BROADCAST_IDS = 500_000  # rows of three numbers that may be broadcast after they were counted
BLOCK = 250  # documents of a family whose sets meet those of another block in one place

_numbers = np.random.default_rng(6).integers(1, 2**63, (2, SYMBOLS), dtype=np.uint64)
_FACTOR, _SHIFT = _numbers[0] * np.uint64(2) + np.uint64(1), _numbers[1]


def sets_of(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    data, offsets = utf8(texts)
    for first, last in chunks(offsets, AT_ONCE):
        part = offsets[first : last + 1]
        words, at = word_hashes(data[part[0] : part[-1]], part - part[0])
        for i in range(last - first):
            yield shingle_set(words[at[i] : at[i + 1]], WORDS)


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that stand for a whole set."""
    one = int(mix(shingles).sum(dtype=np.uint64)) if len(shingles) else 0
    two = int(mix(shingles ^ _SHIFT[0]).sum(dtype=np.uint64)) if len(shingles) else 0
    return one - (one >> 63 << 64), two - (two >> 63 << 64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The symbols, chunk by chunk, ``LANES`` to a long."""
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max)
    for i in range(0, len(shingles), 4096):
        block = shingles[i : i + 4096, None] * _FACTOR + _SHIFT
        np.minimum(least, block.min(axis=0), out=least)
    lanes = np.zeros((CHUNKS, LONGS * LANES), np.uint64)
    lanes[:, : SYMBOLS // CHUNKS] = (mix(least) >> np.uint64(64 - BITS)).reshape(CHUNKS, -1)
    places = np.arange(LANES, dtype=np.uint64) * np.uint64(LANE)
    return (lanes.reshape(-1, LANES) << places).sum(axis=1, dtype=np.uint64).view(np.int64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of shingles falls to each of ``MARKS`` places, 64 to a long."""
    places = (mix(shingles ^ _SHIFT[1]) >> np.uint64(32)).astype(np.int64) % MARKS
    return np.packbits(np.bincount(places, minlength=MARKS).astype(np.uint8) & 1).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, f0, f1, signature, sketch) of each row."""
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.zeros((batch.num_rows, len(names) - 2), np.int64)
            for i, shingles in enumerate(sets_of(batch.column(2))):
                rows[i] = len(shingles), *fingerprint(shingles), *signature(shingles), *sketch(shingles)
            columns = [batch.column(0), batch.column(1), *(pa.array(rows[:, i]) for i in range(rows.shape[1]))]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "text_hash", "n_shingles", "f0", "f1", *SIGNATURE, *SKETCH]
    rows = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.xxhash64("`text`").alias("text_hash"), "`text`")
    return rows.mapInArrow(lean(sign), ", ".join(f"{c} long" for c in names))


def _symbol(i: int) -> Column:
    chunk, place = divmod(i, SYMBOLS // CHUNKS)
    long = F.col(SIGNATURE[chunk * LONGS + place // LANES])
    return F.shiftrightunsigned(long, LANE * (place % LANES)).bitwiseAND(F.lit((1 << BITS) - 1))


def _choices() -> list[tuple[int, ...]]:
    """Of a chunk's symbols, those that agree."""
    return list(combinations(range(SYMBOLS // CHUNKS), SYMBOLS // CHUNKS - ERRORS))


def _keys() -> Column:
    """For each chunk, each choice of the symbols that agree."""
    size = SYMBOLS // CHUNKS
    chosen = [[k * size + i for i in choice] for k in range(CHUNKS) for choice in _choices()]
    return F.array(*(F.xxhash64(F.lit(i), *map(_symbol, c)) for i, c in enumerate(chosen)))


def _differing(chunk: int) -> Column:
    """The number of a chunk's symbols in which sides a and b differ.

    Adding the largest symbol to a lane carries into its spare bit unless the lane is 0.
    """
    most = sum(((1 << BITS) - 1) << (LANE * i) for i in range(LANES))
    spare = sum(1 << (LANE * i + BITS) for i in range(LANES))
    total = F.lit(0)
    for s in SIGNATURE[chunk * LONGS : (chunk + 1) * LONGS]:
        both = F.col(f"a{s}").bitwiseXOR(F.col(f"b{s}"))
        total = total + F.bit_count((both + F.lit(most)).bitwiseAND(F.lit(spare)))
    return total


def _far() -> Column:
    """The number of symbols in which sides a and b differ."""
    return sum((_differing(k) for k in range(CHUNKS)), F.lit(0))


def _first_chunk() -> Column:
    """Whether no chunk before that of key ``number`` has few enough differences to be found by."""
    keys = len(_choices())
    first = F.lit(True)
    for k in range(CHUNKS - 1):
        first = first & ((F.col("number") < keys * (k + 1)) | (_differing(k) > ERRORS))
    return first


def _own(side: str) -> list[Column]:
    """The longs of the chunk of key ``number``."""
    chunk = F.floor(F.col("number") / len(_choices())).cast("int")
    return [F.get(F.array(*(F.col(s) for s in SIGNATURE[i::LONGS])), chunk).alias(f"{side}own{i}") for i in range(LONGS)]


def _earlier() -> list[Column]:
    """Of key ``number``, the spare bits of the symbols that it leaves out before its last one."""
    left_out = [[p for p in range(choice[-1]) if p not in choice] for choice in _choices()]
    bits = [[sum(1 << (LANE * (p % LANES) + BITS) for p in c if p // LANES == i) for c in left_out] for i in range(LONGS)]
    place = (F.col("number") % len(left_out)).cast("int")
    return [F.get(F.array(*(F.lit(b).cast("long") for b in row)), place).alias(f"earlier{i}") for i, row in enumerate(bits)]


def _first_choice() -> Column:
    """Whether no choice before that of key ``number`` finds the pair in this chunk: what it leaves out differs."""
    most = sum(((1 << BITS) - 1) << (LANE * i) for i in range(LANES))
    first = F.lit(True)
    for i in range(LONGS):
        both = F.col(f"aown{i}").bitwiseXOR(F.col(f"bown{i}"))
        first = first & ((both + F.lit(most)).bitwiseAND(F.col(f"earlier{i}")) == F.col(f"earlier{i}"))
    return first


def _sizes_allow() -> Column:
    return 100 * F.least("an", "bn") >= PERCENT * F.greatest("an", "bn")


def _most_differing() -> list[tuple[float, float]]:
    """(slope, start) of lines over the differing shingles of two sets; their sketches differ in fewer places than each.

    The first is the number of shingles itself, the others touch the mean and ``MARGIN`` deviations, which is concave.
    """

    def bound(differing: float) -> float:
        odd = (1 - (1 - 2 / MARKS) ** differing) / 2  # the chance of a place's parity to change
        return MARKS * odd + MARGIN * (MARKS * odd * (1 - odd)) ** 0.5

    lines = [(1.0, 0.0), (0.0, MARKS / 2 + MARGIN * MARKS**0.5 / 2)]
    for at in (MARKS / 4, MARKS / 2, MARKS):
        slope = bound(at + 0.5) - bound(at - 0.5)
        lines.append((slope, bound(at) - slope * at + 0.01))
    return lines


def _sketches_allow() -> Column:
    """Whether the sketches of sides a and b differ in as few places as those of similar sets do.

    Of two sets of the least similarity a seventh of the shingles differ, and each of these changes one parity.
    As it has lambdas, Spark cuts a join's condition into small methods. In one method with the loop over the pairs the
    longs of both sides cost the JVM's compiler 600 MB of an executor, outside the heap.
    """
    odd = F.zip_with("asketch", "bsketch", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    differing = F.aggregate(odd, F.lit(0), lambda total, n: total + n)
    share = (100 - PERCENT) / (100 + PERCENT)
    return differing <= F.least(*((F.col("an") + F.col("bn")) * (slope * share) + start + 1e-6 for slope, start in _most_differing()))


def _sided(classes: DataFrame, side: str, *more: str | Column) -> DataFrame:
    # None is null; that it says so keeps the generated code of a join short enough to be compiled.
    columns = [F.coalesce(c, F.lit(0)).alias(side + name) for c, name in (("n_shingles", "n"), *((s, s) for s in SIGNATURE))]
    sketch = F.array(*(F.coalesce(z, F.lit(0)) for z in SKETCH)).alias(f"{side}sketch")
    return classes.select(F.col("node").alias(side), *columns, sketch, *more)


def _near(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) whose sizes and sketches allow the similarity and whose signatures are not ``FAR`` apart, with ``far``."""
    columns = pairs.columns
    for side in "ab":
        pairs = pairs.join(_sided(classes, side), side)
    pairs = pairs.where(_sizes_allow() & (_far() <= FAR) & _sketches_allow())
    return pairs.select(*columns, _far().alias("far"))


def _blocks(families: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, f0, ``ROW_KEY``, block) for ``families`` (node, family), each cut into blocks of about ``BLOCK`` nodes.

    A family's nodes likely have partners in common; it steers the work only.
    """
    sizes = families.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    block = F.xxhash64("family", F.pmod(F.xxhash64("node"), "blocks")).alias("block")
    found = families.join(sizes, "family").join(classes.select("node", "f0", *ROW_KEY), "node")
    return stored(found.select("node", "f0", *ROW_KEY, block), "blocks")


def confirmed(docs: DataFrame, pairs: DataFrame, blocks: DataFrame) -> DataFrame:
    """The pairs (a, b), given once each, whose full sets are similar enough.

    ``blocks`` has, for each node, the row key of a row with its set, f0, and its block. The pairs between two blocks
    are compared in one place, to which each set comes once however many pairs it is in.
    """
    placed = pairs.select("a", "b")
    for side in "ab":
        placed = placed.join(blocks.select(F.col("node").alias(side), F.col("block").alias(f"{side}_block")), side)
    placed = stored(placed.select("a", "b", F.xxhash64("a_block", "b_block").alias("place")), "placed")
    wanted = placed.select("place", F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stored(wanted.join(blocks.select("node", "f0", *ROW_KEY), "node"), "wanted")
    texts = docs.select(*row_key(F.col("`doc_id`"), F.xxhash64("`text`")), F.col("`text`").alias("text"))
    small = wanted.count() <= BROADCAST_IDS
    texts = texts.join(F.broadcast(wanted) if small else wanted, ROW_KEY)

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = set()  # rows may repeat the one whose set is wanted
        for batch in batches:
            ids, place, f0 = (batch.column(i).to_pylist() for i in (0, 2, 3))
            found = []
            for i, one in enumerate(sets_of(batch.column(1))):
                if (place[i], ids[i]) not in sent and fingerprint(one)[0] == f0[i]:
                    sent.add((place[i], ids[i]))
                    found.append((place[i], ids[i], None, one.tobytes()))
                if found and (len(found) == 256 or i == len(ids) - 1):
                    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                    columns = [pa.array(v, t) for v, t in zip(zip(*found), types)]
                    yield pa.RecordBatch.from_arrays(columns, ["place", "a", "b", "shingles"])
                    found = []

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, sets = None, {}
        for batch in batches:
            links = []
            a_side, b_side = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for i, here in enumerate(batch.column(0).to_pylist()):
                if here != place:
                    place, sets = here, {}
                a, b = a_side[i], b_side[i]
                if b is None:
                    sets[a] = np.frombuffer(batch.column(3)[i].as_py(), np.uint64)
                else:
                    one, other = sets[a], sets[b]
                    at = np.searchsorted(one, other)
                    at[at == len(one)] = 0
                    same = int((one[at] == other).sum())
                    if 100 * same >= PERCENT * (len(one) + len(other) - same):
                        links.append((a, b))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in zip(*links)], ["a", "b"])

    sets = texts.select("node", "text", "place", "f0").mapInArrow(lean(shingles), "place long, a long, b long, shingles binary")
    rows = sets.unionByName(placed.select("place", "a", "b", F.lit(None).cast("binary").alias("shingles")))
    rows = rows.repartition("place").sortWithinPartitions("place", F.col("b").asc_nulls_first())
    return rows.mapInArrow(lean(compare), "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept, stays) of each row of ``docs`` (doc_id, text).

    ``kept`` says that the row has the component's id; ``stays`` also that it has the text which stays for the component.
    """
    signed = stored(signatures(docs), "signatures")
    same = ["f0", "f1", "n_shingles"]
    alike = [F.first(s).alias(s) for s in SIGNATURE + SKETCH]  # equal for equal sets
    # The row that stands for a set: null ids last, so that a component's first row has its smallest id.
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = signed.where("n_shingles > 0").groupBy(*same).agg(F.min(row).alias("first"), *alike)
    key = row_key(F.col("first.doc_id"), F.col("first.text_hash"))
    classes = classes.select(F.monotonically_increasing_id().alias("node"), *same, "first", *key, *SIGNATURE, *SKETCH)
    classes = stored(classes, "classes")
    signs = classes.select("node", *same, *SIGNATURE, *SKETCH)

    keys = classes.select("node", F.posexplode(_keys()).alias("number", "key"))
    common = keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = stored(keys.join(common, "key"), "keys")
    # A key's lead is the member whose keys have the most members: the middle of its group.
    central = shared.groupBy("node").agg(F.sum("members").alias("weight"))
    leads = shared.join(central, "node").groupBy("key").agg(F.max_by("node", "weight").alias("a"))
    led = shared.join(leads, "key").where("a <> node").select("a", F.col("node").alias("b")).distinct()
    led = led.join(central.withColumnRenamed("node", "a"), "a")
    best = _near(led, signs).groupBy("b").agg(F.min_by("a", "far").alias("a"), F.max_by("a", "weight").alias("c"))
    best = stored(best, "leads")
    stars = best.select("a", "b").unionByName(best.select(F.col("c").alias("a"), "b"))
    stars = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    families = central.select("node").join(best.select(F.col("b").alias("node"), F.col("c").alias("family")), "node", "left")
    blocks = _blocks(families.select("node", F.coalesce("family", "node").alias("family")), classes)
    links = stored(confirmed(docs, stars, blocks), "links")

    # What is left: pairs that share a key and are not joined yet, each taken by the first key that finds it. Of those
    # between two components the nearest goes first, as most others need no comparison after it.
    joined = stored(components(links), "components")
    member = shared.select("key", "number", "node").join(joined, "node", "left")
    member = member.select("key", "number", "node", F.coalesce("component", "node").alias("component"))
    split = member.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    member = stored(member.join(split.select("key"), "key").join(signs.drop("f0", "f1"), "node"), "apart")
    one = _sided(member, "a", "key", "number", F.col("component").alias("ac"), *_own("a"), *_earlier())
    other = _sided(member, "b", "key", F.col("component").alias("bc"), *_own("b"))
    apart = (F.col("a") < F.col("b")) & (F.col("ac") != F.col("bc")) & _sizes_allow()
    apart = apart & _first_choice() & (_far() <= FAR) & _first_chunk() & _sketches_allow()
    met = one.join(other, (one["key"] == other["key"]) & apart)
    ends = [f(F.col("ac"), F.col("bc")).alias(name) for f, name in ((F.least, "x"), (F.greatest, "y"))]
    rest = stored(met.select("a", "b", *ends, _far().alias("far")).distinct(), "rest")
    nearest = rest.groupBy("x", "y").agg(F.min_by(F.struct("a", "b"), "far").alias("pair")).select("pair.a", "pair.b")
    nearest = stored(nearest, "nearest")
    more = stored(confirmed(docs, nearest, blocks), "links")
    among = components(rest.select("x", "y", "a", "b").join(more, ["a", "b"]).select(F.col("x").alias("a"), F.col("y").alias("b")))
    among = stored(among, "among")  # components of components
    for side in "xy":
        now = among.select(F.col("node").alias(side), F.col("component").alias(f"{side}_now"))
        rest = rest.join(now, side, "left").withColumn(f"{side}_now", F.coalesce(f"{side}_now", side))
    rest = rest.where("x_now <> y_now").join(nearest, ["a", "b"], "left_anti")
    more = more.unionByName(stored(confirmed(docs, rest, blocks), "links"))

    joined = joined.select(F.col("component").alias("a"), F.col("node").alias("b"))
    found = stored(components(joined.unionByName(more)), "components")
    classes = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    survivors = classes.groupBy("component").agg(F.min("first").alias("survivor"))
    classes = classes.join(survivors, "component").select(*same, "survivor")
    rows = signed.select("doc_id", "text_hash", *same).join(classes, same, "left")
    shown = F.col("n_shingles") > 0
    component = F.when(shown, F.col("survivor.doc_id")).otherwise(F.col("doc_id"))
    kept = F.col("survivor.doc_id").eqNullSafe(F.col("doc_id"))
    stays = kept & (F.col("survivor.text_hash") == F.col("text_hash"))
    marks = [F.when(shown, mark).otherwise(True).alias(name) for name, mark in (("kept", kept), ("stays", stays))]
    return rows.select("doc_id", "text_hash", "n_shingles", component.alias("component_id"), *marks)


def deduplicated(docs: DataFrame) -> DataFrame:
    """One document of each group of near-duplicates, with all its columns; rows that repeat one stay once."""
    found = near_duplicates(docs)
    found = stored(found.select(*row_key(F.col("doc_id"), F.col("text_hash")), "stays"), "stays")
    dropped = stored(found.where("NOT stays").select(*ROW_KEY).distinct(), "dropped")
    kept = join_checked(keyed(docs), dropped, ROW_KEY, "left_anti")
    repeated = found.where("stays").groupBy(*ROW_KEY).count().where("count > 1").select(*ROW_KEY)
    repeated = stored(repeated, "repeated")
    if not repeated.isEmpty():
        once = join_checked(kept, repeated, ROW_KEY, "left_semi").dropDuplicates(ROW_KEY)
        kept = join_checked(kept, repeated, ROW_KEY, "left_anti").unionByName(once)
    return unkeyed(kept, docs)


def op6_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder)).drop("text_hash", "stays")
