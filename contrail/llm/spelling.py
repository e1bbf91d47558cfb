"""Words that are one edit apart, and the frequent form that each of them likely stands for.

Every word of the vocabulary generates its edits: the words that one deletion gives, and those that replacing one
character by a larger one gives. All other edits are these seen from the other word, so each near pair is generated
once, from one side. The edits are probed, as hashes, against blocked Bloom filters of the vocabulary, one filter for
each length, that all tasks have. Only positives become rows; they are shuffled to a join with the vocabulary,
which removes the false ones. So nothing is lost, and the filters only decide how much is shuffled.

A set of filters has ``FILTER_BYTES`` at most. A vocabulary that needs more is probed in several rounds, each with the
filters of some lengths, or of some hashes of one length.

The hash of a word is a polynomial in its characters, so the hashes of all its edits come from its own by a few
additions on whole arrays.

Defined cases: null and empty texts have no words; a null id is written as the empty text where words are drawn for
an edit; rows that repeat a row count again; texts are read in slices that end between words; words of any length
take part, in a filter of their own above ``LONGEST``; ties go to the smaller word in code-point order; an empty table
gives no row; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail.llm.common import documents, join_checked, ship, stored
from contrail.llm.words import mix

LEAST_CHARS, LEAST_TIMES, FACTOR = 7, 2, 10
EDITED = 31  # one in so many of a document's words is taken with a character less
LONGEST = 64  # longer words share a filter
BITS_PER_WORD = 24
FILTER_BYTES = 16 << 20
TASK_WORDS = 400_000  # distinct words that a task adds up before it sends them on
SLICE = 1 << 20
PROBES = 1 << 20  # characters of words whose edits are hashed at a time
_LETTERS = re.compile("[A-Za-zÀ-ÿ]*")
_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_CHARS},}}")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_U = np.uint64


def _runs(text: str) -> Iterator[list[str]]:
    """The lower-cased words of a text that may be long enough, a slice at a time."""
    at = 0
    while at < len(text):
        end = _LETTERS.match(text, min(at + SLICE, len(text))).end()
        # Only A-Z are lower-cased, as bytes.
        yield _RUN.findall(text[at:end].encode().lower().decode())
        at = end


def words_of(doc_id: int | None, text: str) -> Counter:
    """How often each word of a text occurs; one in ``EDITED``, drawn by a checksum, with a character less."""
    found = Counter()
    for runs in _runs(text):
        found.update(runs)
    start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
    taken = Counter()
    for run, n in found.items():
        drawn = zlib.crc32(run.encode(), start)
        if drawn % EDITED == 0:
            at = drawn % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= LEAST_CHARS:
            taken[run] += n
    return taken


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text) that are long and frequent enough."""
    ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                total.update(words_of(doc_id, text.as_py() or ""))
                if len(total) > TASK_WORDS:
                    yield _counted(total)
                    total = Counter()
        if total:
            yield _counted(total)

    rows = docs.select(F.col("`doc_id`").cast("long"), F.col("`text`"))
    counts = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_TIMES)


def _counted(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])


class Filters:
    """Blocked Bloom filters of some lengths: a word sets four bits of one 64-bit block.

    ``shards`` has, for each (length, part), its first block and number of blocks; a length whose filter is too
    large has several parts, by the words' hashes, and this set may have only some of them.
    """

    def __init__(self, shards: dict[tuple[int, int], tuple[int, int]], parts: dict[int, int]):
        self.shards, self.parts = shards, parts
        self.blocks = np.zeros(max((first + n for first, n in shards.values()), default=0), _U)

    def _places(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(block of each hash, -1 where its part is not in this set; the bits it sets)."""
        hashes = mix(hashes)
        key = min(length, LONGEST + 1)
        parts = self.parts.get(key, 0)
        block = np.full(len(hashes), -1, np.int64)
        for part in range(parts):
            if (key, part) in self.shards:
                first, n = self.shards[key, part]
                here = slice(None) if parts == 1 else hashes % _U(parts) == part
                block[here] = first + ((hashes[here] >> _U(32)) * _U(n) >> _U(32)).astype(np.int64)
        bits = np.zeros(len(hashes), _U)
        for shift in (8, 14, 20, 26):
            bits |= _U(1) << (hashes >> _U(shift) & _U(63))
        return block, bits

    def rows(self, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        block, bits = self._places(hashes, length)
        return block[block >= 0], bits[block >= 0].view(np.int64)

    def hits(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """The places of hashes that may be words of this length."""
        block, bits = self._places(hashes, length)
        known = np.flatnonzero(block >= 0)
        return known[(self.blocks[block[known]] & bits[known]) == bits[known]]


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of words of one length, their characters in rows), about ``PROBES`` characters at a time."""
    lengths = np.array([len(w) for w in words], np.int64)
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        step = max(1, PROBES // int(length))
        for i in range(0, len(places), step):
            some = places[i : i + step]
            text = "".join([words[p] for p in some]).encode("utf-32-le")
            yield some, np.frombuffer(text, "<u4").reshape(len(some), -1).astype(_U)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, _U), np.full(n, _BASE)]))[:n]


def hashes_of(letters: np.ndarray) -> np.ndarray:
    return (letters * _powers(letters.shape[1])).sum(axis=1, dtype=_U)


def edits(letters: np.ndarray, alphabet: list[int]) -> Iterator[tuple[int, int | None, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, character put in or None, word, place, hash) of all deletions and of replacements by larger characters."""
    n, length = letters.shape
    terms = letters * _powers(length)
    before = np.cumsum(terms, axis=1, dtype=_U) - terms
    whole = terms.sum(axis=1, dtype=_U)[:, None]
    first = np.ones(letters.shape, bool)
    first[:, 1:] = letters[:, 1:] != letters[:, :-1]  # of equal neighbours any deletion gives the same
    word, place = np.nonzero(first)
    yield length - 1, None, word, place, (before + (whole - before - terms) * _INVERSE)[word, place]
    power = _powers(length)
    for letter in alphabet:
        word, place = np.nonzero(letters < _U(letter))
        yield length, letter, word, place, whole[word, 0] + (_U(letter) - letters[word, place]) * power[place]


def _rounds(sizes: dict[int, int], most: int) -> list[tuple[dict, dict]]:
    """Filters, as ``Filters`` takes them, that together hold all lengths, each set of ``most`` blocks at most."""
    parts, shards = {}, []
    for length, words in sorted(sizes.items()):
        blocks = max(1, -(-words * BITS_PER_WORD // 64))
        parts[length] = -(-blocks // most)
        shards += [((length, part), -(-blocks // parts[length])) for part in range(parts[length])]
    rounds, used = [], most
    for shard, blocks in shards:
        if used + blocks > most:
            rounds.append(({}, parts))
            used = 0
        rounds[-1][0][shard] = (used, blocks)
        used += blocks
    return rounds


def near_words(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n): every pair of ``words`` (word, n), a stored table, that is one edit apart, once."""
    spark = words.sparkSession
    ship(spark)
    group = F.least(F.length("word"), F.lit(LONGEST + 1)).alias("group")
    sizes = {r["group"]: r["words"] for r in words.groupBy(group).agg(F.count("*").alias("words")).collect()}
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct()
    alphabet = sorted(ord(r["letter"]) for r in letters.where("letter <> ''").collect())  # characters of ``_RUN`` only
    found = None
    for shards, parts in _rounds(sizes, filter_bytes // 8):
        empty, lengths = Filters(shards, parts), sorted({length for length, _ in shards})
        full = spark.sparkContext.broadcast(_filled(words.where(group.isin(lengths)), empty))
        near = [*lengths, *(x + 1 for x in lengths)]
        positives = words.where(group.isin(near)).mapInArrow(_prober(full, alphabet), "word string, n long, near string")
        found = positives if found is None else found.unionByName(positives)
    if found is None:
        found = words.select("word", "n", F.col("word").alias("near")).limit(0)
    return found.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select(
        "word", "n", "near", "near_n"
    )


def _filled(words: DataFrame, empty: Filters) -> Filters:
    """The filters with the bits of ``words``; they are at most ``FILTER_BYTES`` large."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, letters in _by_length(batch.column(0).to_pylist()):
                rows = empty.rows(hashes_of(letters), letters.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(r) for r in rows], ["block", "bits"])

    rows = words.select("word").mapInArrow(blocks, "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits"))
    table = rows.toArrow()
    full = Filters(empty.shards, empty.parts)
    full.blocks[table.column("block").to_numpy()] = table.column("bits").to_numpy().view(_U)
    return full


def _prober(full, alphabet: list[int]):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = full.value
        for batch in batches:
            words, times = batch.column(0).to_pylist(), batch.column(1)
            for places, letters in _by_length(words):
                rows, near = [], []
                for length, letter, word, place, hashes in edits(letters, alphabet):
                    hits = filters.hits(hashes, length)
                    put = "" if letter is None else chr(letter)
                    for w, at in zip(places[word[hits]].tolist(), place[hits].tolist()):
                        rows.append(w)
                        near.append(words[w][:at] + put + words[w][at + 1 :])
                if rows:
                    at = pa.array(rows, pa.int64())
                    columns = [batch.column(0).take(at), times.take(at), pa.array(near, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["word", "n", "near"])

    return probe


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): where following the forms ends.

    A form is more frequent than its word by ``FACTOR``, so there are no circles. Each step doubles the distance
    that is followed, and its result is stored.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = join_checked(now, now.select(F.col("word").alias("root"), F.col("root").alias("further")), ["root"], "left")
        moved = stored(step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return now
        now = moved.drop("moved")


def spelling_variants(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each of ``words`` (word, n), a stored table.

    ``form`` is the most frequent near word if it is ``FACTOR`` times as frequent as the word, ``root`` where
    following the forms ends, the word itself if it has none; ``n_near`` is the number of near words.
    """
    pairs = stored(near_words(words, filter_bytes), "near")
    turned = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")
    near = pairs.unionByName(turned).groupBy("word").agg(F.count("*").alias("n_near"), best)
    table = words.join(near, "word", "left")
    frequent = -F.col("best.n") >= FACTOR * F.col("n")
    table = table.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.n")).alias("form_n"),
    )
    table = stored(table, "forms")
    ends = roots(table.where("form IS NOT NULL").select("word", "form"))
    found = join_checked(table, ends, ["word"], "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(stored(word_counts(documents(spark, folder)), "words"))
