"""Document fingerprints by winnowing, and how alike a document is to its neighbour and to an edited self.

All runs of ``GRAM`` characters are hashed by a polynomial whose terms are summed once for the whole text, so each
run's hash is a difference of two sums. Of every ``WINDOW`` consecutive hashes the least one is kept, of equal ones the
rightmost, with its position. So two texts that share ``WINDOW + GRAM - 1`` characters anywhere share a hash at
matching positions, and a text of n characters keeps about ``2 n / (WINDOW + 1)``.

The neighbour of a document is the next one by descending id. Documents are dealt to buckets by ranges of their
ids, and each bucket also gets the first document of the next one, so every neighbour is at hand where a bucket is
read in order, and a text is shuffled once, compressed. Only one key a bucket reaches the driver.

Defined cases: a null text is empty and has an empty fingerprint; a text shorter than ``GRAM`` is one run, and one of
fewer runs than ``WINDOW`` one window; very long texts are winnowed slice by slice with the same result; two empty
fingerprints are alike by 1, one empty one and another by 0; null ids come last, rows with equal ids are ordered by a
hash of their texts, and the neighbour of one of several equal rows is another one of them; a single row is its own
neighbour; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail.llm.common import documents, ship, stored
from contrail.llm.words import mix

GRAM, WINDOW = 16, 64
SLICE = 1 << 20  # runs of a text that are winnowed at a time
_ORDERED = 40  # leading bits of a hash that decide which is least; the others hold the place
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, _U), np.full(n, base, _U)]), dtype=_U)


_UP, _DOWN = (_powers(b, SLICE + 2 * WINDOW + GRAM) for b in (_BASE, pow(_BASE, -1, 1 << 64)))


def grams(letters: np.ndarray, width: int = GRAM) -> np.ndarray:
    """The hash of each run of ``width`` characters; of all of them if there are fewer, none of none."""
    n = len(letters)
    width = min(width, n)
    if n == 0:
        return np.zeros(0, _U)
    sums = np.zeros(n + 1, _U)
    np.cumsum(letters * _UP[:n], dtype=_U, out=sums[1:])
    return mix((sums[width:] - sums[: n - width + 1]) * _DOWN[: n - width + 1] + _U(width))


def _least(values: np.ndarray, window: int) -> np.ndarray:
    """The least of each ``window`` consecutive values, by doubling the width."""
    width = 1
    while 2 * width <= window:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = window - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def selected(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The places of the hashes that winnowing keeps."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.int64)
    low = _U((1 << (64 - _ORDERED)) - 1)
    # The later of equal hashes is the lesser value.
    values = (hashes & ~low) | (low - np.arange(n, dtype=_U))
    least = _least(values, min(window, n))
    kept = np.concatenate([least[:1], least[1:][least[1:] != least[:-1]]])
    return (low - (kept & low)).astype(np.int64)


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the fingerprint of a text, by position."""
    letters = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(_U) if len(text) <= SLICE else None
    if letters is not None:
        hashes = grams(letters, gram)
        places = selected(hashes, window)
        return hashes[places], places
    # Consecutive slices share the windows' overlap, so every window lies in one of them.
    parts, last = [], -1
    for first in range(0, max(1, len(text) - gram - window + 2), SLICE):
        piece = text[first : first + SLICE + gram + window - 2].encode("utf-32-le")
        hashes = grams(np.frombuffer(piece, "<u4").astype(_U), gram)
        places = selected(hashes, window)
        new = places[places + first > last]
        parts.append((hashes[new], new + first))
        last = int(parts[-1][1][-1]) if len(new) else last
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def written(fingerprint: tuple[np.ndarray, np.ndarray]) -> str:
    """``hash:position`` for each kept hash, hashes in hexadecimal."""
    hashes, places = fingerprint
    digits = hashes.astype(">u8").tobytes().hex()
    return ";".join([f"{digits[16 * i : 16 * i + 16]}:{p}" for i, p in enumerate(places.tolist())])


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """The share of distinct hashes that two fingerprints have in common."""
    a, b = set(one.tolist()), set(other.tolist())
    return len(a & b) / len(a | b) if a or b else 1.0


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """(doc_id, hash, position) of every row of ``docs`` (doc_id, text), for indexes of shared passages."""
    ship(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                hashes, places = winnow(batch.column(1)[i].as_py() or "", gram, window)
                if len(hashes):
                    ids = pa.array([batch.column(0)[i].as_py()] * len(hashes), pa.int64())
                    columns = [ids, pa.array(hashes.view(np.int64)), pa.array(places)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "hash", "position"])

    kept = docs.select(F.col("`doc_id`").cast("long"), F.col("`text`"))
    return kept.mapInArrow(rows, "doc_id long, hash long, position long")


_KEY = ["k0", "k1", "k2"]


def _keyed(docs: DataFrame, *more) -> DataFrame:
    """``docs`` with three numbers whose order is that of the neighbours: descending id, null last, then text."""
    doc_id = F.col("`doc_id`").cast("long")
    values = doc_id.isNull().cast("long"), F.coalesce(F.bitwise_not(doc_id), F.lit(0)), F.xxhash64("`text`")
    return docs.select(*(v.alias(k) for v, k in zip(values, _KEY)), *more)


def _bucket_heads(docs: DataFrame) -> list[tuple[int, int, int]]:
    """The first key of each of about as many ranges of keys as there are shuffle partitions."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = stored(_keyed(docs), "keys").repartitionByRange(parts, *_KEY)
    heads = keys.groupBy(F.spark_partition_id()).agg(F.min(F.struct(*_KEY)).alias("head"))
    return sorted(tuple(r["head"]) for r in heads.collect())


ROWS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [c.split()[0] for c in ROWS.split(", ")]


def edited(text: str, following: str) -> str:
    """A text with its last third replaced by the beginning of another."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def compared(docs: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of each row of ``docs`` (doc_id, text) and of its edited text, and their likenesses, as ``ROWS``."""
    spark = docs.sparkSession
    ship(spark)
    heads = _bucket_heads(docs)
    if not heads:
        return spark.createDataFrame([], ROWS)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            rows = []
            for i, key in enumerate(keys):
                text = (batch.column(4)[i].as_py() or "").encode()
                row = (batch.column(3)[i].as_py(), len(text), codec.compress(text, asbytes=True) if text else b"")
                bucket = bisect_right(heads, key) - 1
                rows.append((bucket, 0, *key, *row))
                if key == heads[bucket]:
                    rows.append(((bucket - 1) % len(heads), 1, *key, *row))
                if len(rows) >= 512 or i == len(keys) - 1:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 7 + [pa.binary()])]
                    yield pa.RecordBatch.from_arrays(columns, ["bucket", "ahead", *_KEY, "doc_id", "n_bytes", "packed"])
                    rows = []

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, before, bucket, met, found, size = pa.Codec("zstd"), None, None, False, [], 0
        for batch in batches:
            buckets, ahead, ids, sizes = (batch.column(i).to_pylist() for i in (0, 1, 2, 3))
            for i in range(batch.num_rows):
                if buckets[i] != bucket:
                    bucket, before, met = buckets[i], None, False
                if met:  # further rows that equal the next bucket's first
                    continue
                packed = batch.column(4)[i].as_py()
                text = codec.decompress(packed, sizes[i], asbytes=True).decode() if packed else ""
                here = ids[i], text, winnow(text, gram, window)
                if before is not None:
                    found.append(_compared(*before, *here[1:], gram, window))
                    size += len(found[-1][3])
                before, met = here, bool(ahead[i])
                if size > 1 << 22:
                    yield _batch(found)
                    found, size = [], 0
        if found:
            yield _batch(found)

    dealt = _keyed(docs, F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`").alias("text"))
    keys = ", ".join(f"{k} long" for k in _KEY)
    dealt = dealt.mapInArrow(deal, f"bucket long, ahead long, {keys}, doc_id long, n_bytes long, packed binary")
    ordered = dealt.repartitionById(len(heads), F.col("bucket").cast("int")).sortWithinPartitions("bucket", "ahead", *_KEY)
    return ordered.select("bucket", "ahead", "doc_id", "n_bytes", "packed").mapInArrow(compare, ROWS)


def _compared(doc_id, text, fingerprint, following, next_fingerprint, gram, window) -> tuple:
    changed = edited(text, following)
    other = winnow(changed, gram, window)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    near = likeness(fingerprint[0], other[0]), likeness(fingerprint[0], next_fingerprint[0])
    return doc_id, len(text), digest, written(fingerprint), written(other), *near


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], _NAMES)


def op13_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return compared(documents(spark, folder))
