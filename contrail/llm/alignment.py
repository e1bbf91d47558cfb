"""Which tokens of two tokenizers cover the same bytes, over a whole corpus.

Both tokenizers encode each text with a space before it. Byte offsets at which tokens of both end cut the tokens
into groups; within a group every pair of tokens whose bytes overlap is linked. Most groups hold one token of
either side, and those are the fast path: an array, made once, gives for each A id the B id of the same bytes, and
groups that follow it are counted in a vector as long as A's vocabulary. Only the links of the other, irregular
groups become rows of (pair, count), which are added up in each task before they are shuffled.

A second pass gives every document the counts of its links. Regular links look theirs up in the vector. Of the
irregular pairs the ``HOT_PAIRS`` most frequent ones, a fixed number of rows, go to all tasks, so no pair that many
documents hold is a hot key; the rare rest is joined by a shuffle. The numbers don't depend on that division.

No token of either side reaches over a space between two visible characters, from a letter to a mark after it, or
over the beginning of a line, so a text is cut there (``CUT``), and equal pieces are encoded and aligned once. ``Aligner``
checks this against B's vocabulary.

Defined cases: null and empty texts, and texts that either side doesn't reproduce byte by byte, have no tokens and
only zeros; strings of special tokens are plain text; texts of any length are cut and counted slice by slice; a
piece without a cut is encoded whole; rows with equal or null ids are separate rows, and rows that repeat one count
again; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail.llm.common import documents, ship, stored

_LETTER, _MARK = "A-Za-zÀ-ÖØ-öø-ɏ", ".,;:!?"
# Blank characters other than the ASCII ones lie outside these ranges, and so do marks.
_SEEN = r"\"-+\-/-9<->@-~¡-ᙿ、-퟿"
# A piece that begins with a mark or a line end has no space before it; only a text's first one may, see ``_pieces``.
CUT = re.compile(f"(?<=[^ ]) (?=[{_SEEN}])|(?<=[{_LETTER}])(?=[{_MARK}])|(?<=[{_SEEN}{_MARK}])(?=\n)")
_JOINED = tuple(_MARK + "\n")
_SPACED = "\ud800"  # stands before a first piece of that kind; no text can hold it
SLICE = 1 << 20  # characters of a text that are cut at a time
CACHED, LONGEST = 500_000, 64  # pieces that a Python worker keeps, and their length
TASK_PAIRS = 400_000  # distinct irregular pairs that a task adds up before it sends them on
HOT_PAIRS = 500_000  # irregular pairs that go to all tasks, 17 bytes each
_SPACE = "▁"  # B's sign for a space
_LETTERS, _MARKS = re.compile(f"[{_LETTER}]+"), re.compile(f"[{_MARK}]+")


def byte_level() -> dict[str, int]:
    """The byte that each character of A's entries stands for: printable ones themselves, the others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Encodes pieces with both tokenizers and keeps what their alignment gives, piece by piece."""

    def __init__(self, a_path: str, b_path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        codes = byte_level()
        self.signs = str.maketrans({byte: sign for sign, byte in codes.items()})
        vocabulary = sorted(self.a.get_vocab().items(), key=lambda e: e[1])
        self.a_bytes = [b""] * (vocabulary[-1][1] + 1)
        for entry, i in vocabulary:
            self.a_bytes[i] = bytes(codes[c] for c in entry) if all(c in codes for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(_SPACE in p.lstrip(_SPACE) for p in pieces):
            raise ValueError("a token of B holds a space after another character; texts can't be cut at spaces")
        if any(re.search(f"[{_LETTER}][{_MARK}]|\n", p) for p in pieces) or len(self.b.encode("a")) != 1:
            raise ValueError("a token of B holds a letter and a mark, or a line end; texts can't be cut there")
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.n_a, self.n_b = len(self.a_bytes), len(self.b_bytes)
        self.a_size, self.b_size = [len(x) for x in self.a_bytes], [len(x) for x in self.b_bytes]
        same = {x: i for i, x in enumerate(self.b_bytes) if not self.b.is_control(i) and not self.b.is_unknown(i)}
        same |= {x: i for i, x in enumerate(self.b_bytes) if not self.b.is_byte(i) and x in same}
        #: The B id with the bytes of each A id, or -1.
        self.identity = np.array([same.get(x, -1) for x in self.a_bytes], np.int64)
        self._identity = self.identity.tolist()
        self._a_names, self._b_names = [str(i) for i in range(self.n_a)], [str(i) for i in range(self.n_b)]
        self.index: dict[str, int] = {}
        self.texts: list[bytes | None] = []  # the groups of each piece, None where a side doesn't reproduce it
        self.sizes = np.zeros((0, 4), np.int32)  # tokens of A, of B, groups, links
        self.uses = np.zeros(0, np.int32)
        self.regular, self.irregular = _Lists(np.int32), _Lists(np.int64)

    def forget(self) -> None:
        """Keep the pieces that were met more than once, at most half of what may be kept."""
        least = 2
        if len(self.uses) > CACHED // 2:
            least = max(least, int(np.partition(self.uses, -(CACHED // 2))[-(CACHED // 2)]) + 1)
        kept = [(piece, n) for piece, n in self.index.items() if self.uses[n] >= least]
        places = np.array([n for _, n in kept], np.int64)
        self.index = {piece: i for i, (piece, _) in enumerate(kept)}
        self.texts = [self.texts[n] for n in places.tolist()]
        self.sizes, self.uses = self.sizes[places], np.ones(len(places), np.int32)
        self.regular, self.irregular = self.regular.only(places), self.irregular.only(places)

    def _a_ids(self, piece: str, spaced: bool) -> list[int]:
        # Letters, and marks, are one part for the tokenizer, which its model takes directly.
        if spaced and _LETTERS.fullmatch(piece):
            return [t.id for t in self.a.model.tokenize(f" {piece}".encode().decode("latin-1").translate(self.signs))]
        if not spaced and _MARKS.fullmatch(piece):
            return [t.id for t in self.a.model.tokenize(piece)]
        return self.a.encode(f" {piece}" if spaced else piece, add_special_tokens=False).ids

    def align(self, a: list[int], b: list[int]) -> tuple[bytes, int, list[int], list[int]]:
        """(groups as text, their number, A ids of regular groups, pairs of irregular links) of tokens of the same bytes."""
        a_size, b_size, identity, n_b = self.a_size, self.b_size, self._identity, self.n_b
        a_names, b_names = [self._a_names[x] for x in a], [self._b_names[x] for x in b]
        groups, regular, irregular = [], [], []
        i = j = first_i = first_j = 0
        a_end, b_end = a_size[a[0]], b_size[b[0]]
        while True:
            if a_end == b_end:
                if i == first_i and j == first_j and identity[a[i]] == b[j]:
                    regular.append(a[i])
                else:
                    irregular.append(a[i] * n_b + b[j])
                i, j = i + 1, j + 1
                groups.append(f"{','.join(a_names[first_i:i])}|{','.join(b_names[first_j:j])}")
                if i == len(a):
                    return ";".join(groups).encode(), len(groups), regular, irregular
                first_i, first_j = i, j
                a_end, b_end = a_end + a_size[a[i]], b_end + b_size[b[j]]
            else:
                irregular.append(a[i] * n_b + b[j])
                if a_end < b_end:
                    i += 1
                    a_end += a_size[a[i]]
                else:
                    j += 1
                    b_end += b_size[b[j]]

    def _learn(self, pieces: list[str]) -> None:
        spaced = [not piece.startswith(_JOINED) for piece in pieces]
        plain = [piece.removeprefix(_SPACED) for piece in pieces]
        # B puts a space before what it encodes; a piece without one is encoded behind a letter.
        encoded = self.b.encode([p if s else f"a{p}" for p, s in zip(plain, spaced)], num_threads=1)
        sizes, all_regular, all_irregular, a_bytes, b_bytes = [], [], [], self.a_bytes, self.b_bytes
        for key, piece, own_space, b in zip(pieces, plain, spaced, encoded):
            a, b = self._a_ids(piece, own_space), b if own_space else b[1:]
            whole = (f" {piece}" if own_space else piece).encode()
            if b"".join([a_bytes[x] for x in a]) == whole and b"".join([b_bytes[x] for x in b]) == whole:
                text, n_groups, regular, irregular = self.align(a, b)
                sizes.append((len(a), len(b), n_groups, len(regular) + len(irregular)))
            else:
                text, regular, irregular = None, [], []
                sizes.append((0, 0, 0, 0))
            self.index[key] = len(self.texts)
            self.texts.append(text)
            all_regular.append(regular)
            all_irregular.append(irregular)
        self.sizes = _grown(self.sizes, len(self.texts) - len(pieces), np.array(sizes, np.int32))
        self.uses = _grown(self.uses, len(self.texts) - len(pieces), np.zeros(len(pieces), np.int32))
        self.regular.extend(all_regular)
        self.irregular.extend(all_irregular)

    def __call__(self, text: str) -> tuple[list[int], str, tuple, tuple]:
        """(sizes, digest of the groups, (A id, times) of regular groups, (pair, times) of irregular links) of a text."""
        sizes, digest, regular, irregular = np.zeros(4, np.int64), hashlib.sha256(), [], []
        for n, pieces in enumerate(_pieces(text)):
            new = list(set(pieces).difference(self.index))
            if new:
                if len(self.texts) + len(new) > CACHED:
                    self.forget()
                    new = list(set(pieces).difference(self.index))
                self._learn(new)
            places = list(map(self.index.__getitem__, pieces))
            groups = [self.texts[p] for p in places]
            if None in groups:
                return [0, 0, 0, 0], "", _NOTHING, _NOTHING
            digest.update(b";" * (n > 0) + b";".join(groups))
            places = np.array(places)
            np.add.at(self.uses, places, 1)
            sizes += self.sizes[places].sum(axis=0)
            regular.append(_counted([(self.regular.at(places), None)]))
            irregular.append(_counted([(self.irregular.at(places), None)]))
            for piece in new:
                if len(piece) > LONGEST:  # its place stays unused until others are forgotten
                    del self.index[piece]
        if not regular:
            return [0, 0, 0, 0], "", _NOTHING, _NOTHING
        return sizes.tolist(), digest.hexdigest(), _counted(regular), _counted(irregular)


def _grown(array: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``array`` with ``more`` after its first ``used`` rows, with room for as many again when it must grow."""
    end = used + len(more)
    if end > len(array):
        room = np.zeros((max(2 * end, 1024), *array.shape[1:]), array.dtype)
        room[:used] = array[:used]
        array = room
    array[used:end] = more
    return array


class _Lists:
    """Many short lists of numbers in one array."""

    def __init__(self, kind: type):
        self.values, self.ends, self.n = np.zeros(0, kind), np.zeros(1, np.int64), 0

    def extend(self, lists: list[list[int]]) -> None:
        used = int(self.ends[self.n])
        values = np.array([v for one in lists for v in one], self.values.dtype)
        ends = used + np.cumsum([len(one) for one in lists])
        self.values = _grown(self.values, used, values)
        self.ends = _grown(self.ends, self.n + 1, ends)
        self.n += len(lists)

    def only(self, places: np.ndarray) -> _Lists:
        """The lists at ``places`` alone."""
        kept = _Lists(self.values.dtype)
        kept.values, kept.n = self.at(places), len(places)
        kept.ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.ends[places + 1] - self.ends[places])])
        return kept

    def at(self, places: np.ndarray) -> np.ndarray:
        """The numbers of the lists at ``places``, one after the other."""
        first = self.ends[places]
        lengths = self.ends[places + 1] - first
        before = np.cumsum(lengths) - lengths
        return self.values[np.repeat(first - before, lengths) + np.arange(int(lengths.sum()))]


_NOTHING = (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _counted(parts: list[tuple[np.ndarray, np.ndarray | None]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, sorted, and their number; parts without numbers count each value once."""
    if len(parts) == 1:
        values, times = parts[0]
        if times is not None:
            return parts[0]
        values, times = np.unique(values, return_counts=True)
        return values.astype(np.int64), times.astype(np.int64)
    values, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    times = np.zeros(len(values), np.int64)
    np.add.at(times, place, np.concatenate([p[1] for p in parts]))
    return values, times


def _pieces(text: str) -> Iterator[list[str]]:
    """The pieces of a text, a slice of it at a time; without the space before each, which the first one has too."""
    at = 0
    while at < len(text):
        cut = CUT.search(text, at + SLICE) if len(text) > at + SLICE else None
        pieces = CUT.split(text[at : cut.start()] if cut else text[at:])
        if at == 0 and pieces[0].startswith(_JOINED):
            pieces[0] = _SPACED + pieces[0]
        yield pieces
        at = cut.end() if cut else len(text)


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One per Python worker, however many tasks it runs."""
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    return _ALIGNERS[a_path, b_path]


ROWS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
COUNTS = "ids array<int>, id_times array<long>, pairs array<long>, pair_times array<long>"


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=ends[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values).cast(kind))


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Each row of ``docs`` (_row, doc_id, text) with its sizes and counts, and rows of the tasks' totals.

    A total has no ``_row``; its ``pairs`` and ``pair_times`` are what the task's documents hold together, regular
    ones included.
    """
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(a_path, b_path)
        vector, waiting, n_waiting = np.zeros(align.n_a, np.int64), [], 0
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                found = [align(text.as_py() or "") for text in part.column(2)]
                for _, _, (ids, times), irregular in found:
                    vector[ids] += times
                    waiting.append(irregular)
                    n_waiting += len(irregular[0])
                yield _batch([part.column(0), part.column(1)], found)
                if n_waiting > 4 * TASK_PAIRS:
                    waiting = [_counted(waiting)]
                    n_waiting = len(waiting[0][0])
                    if n_waiting > TASK_PAIRS:
                        yield _total(*waiting[0])
                        waiting, n_waiting = [], 0
        ids = np.flatnonzero(vector)
        if len(ids):
            yield _total(ids * align.n_b + align.identity[ids], vector[ids])
        if n_waiting:
            yield _total(*_counted(waiting))

    return docs.mapInArrow(rows, f"_row long, doc_id long, {ROWS}, {COUNTS}")


_NAMES = ["_row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "ids", "id_times", "pairs", "pair_times"]


def _batch(keys: list[pa.Array], found: list[tuple]) -> pa.RecordBatch:
    sizes = [pa.array([f[0][i] for f in found], pa.int64()) for i in range(4)]
    lists = [_lists([f[2][0] for f in found], pa.int32()), _lists([f[2][1] for f in found], pa.int64())]
    lists += [_lists([f[3][i] for f in found], pa.int64()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays([*keys, *sizes, pa.array([f[1] for f in found], pa.string()), *lists], _NAMES)


def _total(pairs: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    unknown = [pa.nulls(1, pa.int64())] * 2
    return _batch(unknown, [([0, 0, 0, 0], "", _NOTHING, (pairs, times))])


def pair_counts(table: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, top) from what ``aligned`` gives: the links of each id pair, and whether its B id has no pair of more."""
    totals = table.where("_row IS NULL").select(F.explode(F.arrays_zip("pairs", "pair_times")).alias("one"))
    totals = totals.select(F.col("one.pairs").alias("pair"), F.col("one.pair_times").alias("n"))
    counts = stored(totals.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    most = counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("most"))
    counts = counts.withColumn("b", F.col("pair") % n_b)
    # One row for each id of B's vocabulary at most.
    return stored(counts.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("top")), "counts")


def _arrays(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, n, top) sorted by pair; only for tables of bounded size."""
    table = counts.toArrow()
    pair, n, top = (table.column(c).to_numpy() for c in ("pair", "n", "top"))
    order = np.argsort(pair)
    return pair[order], n[order], top[order].astype(np.int64)


def _hot(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """``counts`` in two: at most ``most`` of the most frequent pairs, down to some power of two, and the others."""
    level = F.floor(F.log2("n")).cast("int")
    levels = sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("rows")).collect(), reverse=True)
    least, rows = 64, 0
    for row in levels:
        rows += row["rows"]
        if rows > most:
            break
        least = row["level"]
    return counts.where(level >= least), counts.where(level < least)


def alignments(docs: DataFrame, a_path: str, b_path: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`").alias("text")
    )
    table = stored(aligned(rows, a_path, b_path), "aligned")
    both = aligner(a_path, b_path)
    n_b, identity = both.n_b, both.identity
    counts = pair_counts(table, n_b)

    known = np.flatnonzero(identity >= 0)
    regular = spark.createDataFrame(pa.table({"pair": known * n_b + identity[known]}))  # A's vocabulary at most
    pairs, times, top = _arrays(counts.join(F.broadcast(regular), "pair", "left_semi"))
    of_id = np.zeros((both.n_a, 2), np.int64)
    of_id[pairs // n_b] = np.stack([times, top], axis=1)
    hot, rare = _hot(counts, hot_pairs)
    shared = spark.sparkContext.broadcast((of_id, *_arrays(hot)))

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_id, hot_pair, hot_n, hot_top = shared.value
        for batch in batches:
            lists = [(batch.column(c).offsets.to_numpy(), batch.column(c).values.to_numpy()) for c in COLUMNS]
            rows = batch.column(0).to_numpy()
            sums, others = np.zeros((batch.num_rows, 2), np.int64), []
            for i, row in enumerate(rows):
                ids, id_times, pairs, pair_times = (values[ends[i] : ends[i + 1]] for ends, values in lists)
                sums[i] = id_times @ of_id[ids]
                at = np.searchsorted(hot_pair, pairs)
                at[at == len(hot_pair)] = 0
                found = hot_pair[at] == pairs if len(hot_pair) else np.zeros(len(pairs), bool)
                at, times = at[found], pair_times[found]
                sums[i] += (times * hot_n[at]).sum(), (times * hot_top[at]).sum()
                if not found.all():
                    left = pairs[~found]
                    others.append(np.stack([np.full(len(left), row), left, pair_times[~found]]))
            own = [*(batch.column(c) for c in batch.schema.names[:7]), *(pa.array(sums[:, i]) for i in (0, 1))]
            n = batch.num_rows
            # A document's own row meets no pair; its key only spreads such rows.
            yield pa.RecordBatch.from_arrays([*own, pa.array(-1 - rows), pa.array(np.zeros(n, np.int64))], names)
            if others:
                row, left, times = np.concatenate(others, axis=1)
                nothing = [pa.nulls(len(row), f.type) for f in list(batch.schema)[1:7]]
                zeros = [pa.array(np.zeros(len(row), np.int64))] * 2
                yield pa.RecordBatch.from_arrays([pa.array(row), *nothing, *zeros, pa.array(left), pa.array(times)], names)

    COLUMNS = ["ids", "id_times", "pairs", "pair_times"]
    names = ["_row", *_NAMES[1:7], "count_sum", "n_best", "pair", "times"]
    found = table.where("_row IS NOT NULL").mapInArrow(
        looked_up, f"_row long, doc_id long, {ROWS}, count_sum long, n_best long, pair long, times long"
    )
    met = found.join(rare, "pair", "left")
    n, top = F.coalesce("n", F.lit(0)), F.coalesce(F.col("top").cast("int"), F.lit(0))
    own = [F.max(c).alias(c) for c in names[1:6]]
    return met.groupBy("_row").agg(
        *own, F.sum(F.col("n_best") + F.col("times") * top).alias("n_best"),
        F.sum(F.col("count_sum") + F.col("times") * n).alias("count_sum"), F.max("groups_sha256").alias("groups_sha256"),
    ).drop("_row")


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignments(documents(spark, folder), *paths)
