"""Documents that hold passages of a benchmark, found by spaced-seed hashing.

A window of ``WINDOW`` words is cut into blocks. A mask keeps the words of all but ``SUBSTITUTED`` blocks and
ignores the others, for every choice of blocks; so windows that differ in up to ``SUBSTITUTED`` words agree
under some mask. Hashes of all windows under all masks are joined between the benchmark and the documents, and
every distinct window that meets is compared word by word: at most ``SUBSTITUTED`` words may differ. A verified
window stands for all items and places that hold it; verified windows along one alignment make an overlap.

Words end at white space and ASCII punctuation, A-Z count as a-z. Benchmark items of fewer words than a window
are searched as a whole and without substitutions; below ``SHORTEST`` words an item is not searched for, as it
would hit clean text.

Before the join a bit set of fixed size, made from the benchmark's hashes, drops the windows that can't meet.
It only saves work: what it lets pass wrongly, the join drops.

Defined cases: null, empty and short texts hold nothing; very long texts are hashed in pieces, all of them;
rows that are equal in id and text share their overlaps; a null id is an id of its own; items with equal
windows have an overlap each; an empty table on either side gives no overlaps; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail.llm.common import ROW_KEY, documents, join_checked, keyed, lean, row_key, ship, stored, unkeyed
from contrail.llm.words import LETTERED, chunks, sequence_hash, utf8, word_hashes

WINDOW, SUBSTITUTED, SHORTEST = 12, 2, 5
BLOCKS = 2 * SUBSTITUTED
PIECE = 1_000  # items and places of one window that meet its hits in one place
AT_ONCE = 1 << 19  # bytes of texts hashed together, which bounds a Python worker's temporary arrays
BIT_SET = 24  # 2 ** 24 bits, two for each hash

Mask = tuple[int, list[int]]  # words in the window, places that are kept


def masks(lengths: list[int]) -> list[Mask]:
    """The masks of a window, and one that keeps all words for each of the shorter ``lengths``."""
    size = WINDOW // BLOCKS
    kept = combinations(range(BLOCKS), BLOCKS - SUBSTITUTED)
    spaced = [(WINDOW, [p for b in blocks for p in range(b * size, (b + 1) * size)]) for blocks in kept]
    return spaced + [(n, list(range(n))) for n in lengths]


def _windows(words: np.ndarray, at: np.ndarray, mask: Mask) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, place in the text) of the windows that lie in one text."""
    length, places = mask
    hashes = sequence_hash(words, places, length)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(hashes)]
    whole = np.arange(len(hashes)) + length <= at[text + 1]
    return hashes[whole], text[whole], np.flatnonzero(whole) - at[text[whole]]


def _bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << BIT_SET) - 1)
    return (hashes & low).astype(np.int64), ((hashes >> np.uint64(BIT_SET)) & low).astype(np.int64)


def _hashed(rows: DataFrame, lengths: list[int], only: bool, bits=None) -> DataFrame:
    """(id, text_hash, hash, place, words) of the windows of ``rows`` (id, text, text_hash).

    ``only``: the rows are items, whose masks follow their length; else all masks apply. ``bits``: a broadcast
    bit set that windows must be in.
    """
    ship(rows.sparkSession)
    chosen = masks(lengths)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if bits is None else np.unpackbits(bits.value.view(np.uint8), bitorder="little").view(bool)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, last in chunks(offsets, AT_ONCE):
                part = offsets[first : last + 1]
                words, at = word_hashes(data[part[0] : part[-1]], part - part[0], LETTERED)
                for number, mask in enumerate(chosen):
                    hashes, text, place = _windows(words, at, mask)
                    # A mask's number is part of the hash, so that different masks don't meet.
                    hashes = (hashes ^ np.uint64(number)) * np.uint64(0x9E3779B97F4A7C15)
                    wanted = np.ones(len(hashes), bool)
                    if only:
                        n = np.diff(at)[text]
                        wanted = n >= WINDOW if mask[0] == WINDOW else n == mask[0]
                    if known is not None:
                        one, two = _bits(hashes)
                        wanted = known[one]
                        wanted[wanted] = known[two[wanted]]
                    chosen_rows = np.flatnonzero(wanted)
                    for i in range(0, len(chosen_rows), 4096):
                        some = chosen_rows[i : i + 4096]
                        begin = at[text[some]] + place[some]
                        windows = words[begin[:, None] + np.arange(mask[0])].astype("<u8")
                        rows_at = pa.array(first + text[some])
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(rows_at),
                                batch.column(2).take(rows_at),
                                pa.array(hashes[some].view(np.int64)),
                                pa.array(place[some].astype(np.int32)),
                                pa.array([w.tobytes() for w in windows], pa.binary()),
                            ],
                            ["id", "text_hash", "hash", "place", "words"],
                        )

    schema = "id long, text_hash long, hash long, place int, words binary"
    return rows.select("id", "text", "text_hash").mapInArrow(lean(hashed), schema)


def _rows(df: DataFrame, identity: str) -> DataFrame:
    text = F.col("`text`")
    return df.select(
        F.col(f"`{identity}`").cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash")
    )


def _bit_set(seeds: DataFrame) -> np.ndarray:
    """2 ** BIT_SET bits; the sums that reach the driver are its words, however large the benchmark."""
    low = F.lit((1 << BIT_SET) - 1)
    two = F.array(F.col("hash").bitwiseAND(low), F.shiftrightunsigned("hash", BIT_SET).bitwiseAND(low))
    bits = seeds.select(F.explode(two).alias("bit"))
    word = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits")
    )
    found = word.toPandas()
    bit_set = np.zeros(1 << BIT_SET - 6, np.int64)
    bit_set[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return bit_set


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, start, end, windows): passages of items in documents, in words of the document.

    One row for each document, item and alignment; ``windows`` of them were verified. ``docs`` has doc_id and
    text, ``benchmark`` item_id and text.
    """
    spark = docs.sparkSession
    items = _rows(benchmark, "item_id")
    # Lengths under a window: WINDOW - SHORTEST numbers at most.
    n = F.size(F.filter(F.split("text", "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"), lambda w: w != ""))
    counted = items.where("text IS NOT NULL").select(n.alias("n")).where(F.col("n").between(SHORTEST, WINDOW - 1))
    lengths = sorted(r["n"] for r in counted.distinct().collect())
    seeds = _hashed(items, lengths, only=True)
    seeds = seeds.select("hash", F.col("words").alias("item_words"), F.col("id").alias("item_id"), F.col("place").alias("item_place"))
    seeds = stored(seeds, "item-windows")
    # Equal windows are one until they are verified.
    holders = seeds.select("item_words", "item_id", "item_place").distinct()
    pieces = F.ceil(F.count("*") / PIECE).alias("pieces")
    distinct = holders.groupBy("item_words").agg(pieces).withColumn("window", F.monotonically_increasing_id())
    distinct = stored(distinct, "windows")
    piece = F.pmod(F.xxhash64("item_id", "item_place"), "pieces").alias("piece")
    holders = stored(holders.join(distinct, "item_words").select("window", piece, "item_id", "item_place"), "holders")
    seeds = stored(seeds.select("hash", "item_words").distinct().join(distinct, "item_words"), "seeds")
    bits = spark.sparkContext.broadcast(_bit_set(seeds))
    hits = _hashed(_rows(docs, "doc_id"), lengths, only=False, bits=bits)
    # A hash repeats where windows differ at ignored places only.
    met = join_checked(hits, seeds, ["hash"])

    # Word hashes side by side: eight bytes each.
    length = F.length("words") / 8
    word = lambda name, i: F.substring(F.col(name), i * 8 + 1, F.lit(8))
    differ = sum(
        (F.when(word("words", F.lit(i)) == word("item_words", F.lit(i)), 0).otherwise(1) for i in range(WINDOW)),
        F.lit(0),
    )
    most = F.when(length >= WINDOW, SUBSTITUTED).otherwise(0)
    same = met.where((F.length("words") == F.length("item_words")) & (differ <= most))
    # A window may be verified under several masks, and under one id by several items.
    found = same.select("id", "text_hash", "place", length.cast("int").alias("length"), "window", "pieces").distinct()
    found = found.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1))).drop("pieces")
    along = (F.col("place") - F.col("item_place")).alias("along")
    once = join_checked(found, holders, ["window", "piece"])
    once = once.select("id", "text_hash", "item_id", "place", along, "length").distinct()
    return once.groupBy("id", "text_hash", "item_id", "along").agg(
        F.min("place").alias("start"), F.max(F.col("place") + F.col("length")).alias("end"), F.count("*").alias("windows")
    ).select(F.col("id").alias("doc_id"), "text_hash", "item_id", "start", "end", "windows")


def _by_row(found: DataFrame) -> DataFrame:
    """Overlaps with the key of the rows they are in."""
    return found.select(*row_key(F.col("doc_id"), F.col("text_hash")), "item_id", "start", "end")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, overlaps, longest, item_id, contaminated) of each row of ``docs``.

    ``longest`` is the length of the longest overlap in words, ``item_id`` the smallest item that has it.
    """
    found = _by_row(overlaps(docs, benchmark)).withColumn("n", F.col("end") - F.col("start"))
    best = F.max(F.struct("n", (-F.col("item_id")).alias("item"))).alias("best")
    by_row = found.groupBy(*ROW_KEY).agg(F.count("*").alias("overlaps"), best)
    by_row = by_row.select(
        *ROW_KEY, "overlaps", F.col("best.n").alias("longest"), (-F.col("best.item")).alias("item_id")
    )
    rows = keyed(docs, ["doc_id"])
    return join_checked(rows, stored(by_row, "found"), ROW_KEY, "left").select(
        "row.doc_id", F.coalesce("overlaps", F.lit(0)).cast("long").alias("overlaps"),
        F.coalesce("longest", F.lit(0)).cast("int").alias("longest"), "item_id",
        F.col("overlaps").isNotNull().alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark."""
    found = stored(_by_row(overlaps(docs, benchmark)).select(*ROW_KEY).distinct(), "found")
    return unkeyed(join_checked(keyed(docs), found, ROW_KEY, "left_anti"), docs)


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return contamination(documents(spark, folder), benchmark)
