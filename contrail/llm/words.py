"""Words of many texts as 64-bit hashes, computed on whole Arrow batches with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20  # bytes hashed at a time, which bounds the temporary arrays
_BASE = np.uint64(0x9E3779B97F4A7C15)


def byte_values(separators: list[int]) -> np.ndarray:
    """A random odd number for each byte, 0 for separators, the same for A-Z as for a-z."""
    values = np.random.default_rng(0x5EED).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    values[separators] = 0
    return values


SPACED = byte_values([0x20, *range(0x09, 0x0E)])  # words end at white space
LETTERED = byte_values([b for b in range(0x80) if not chr(b).isalnum()])  # and at ASCII punctuation


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose result bits each depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of the texts in them); a null is an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data and data.size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes together; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def _piece(data: np.ndarray, breaks: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of the words; ``breaks`` are places where a new text begins."""
    inside = (values != 0)[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    start[breaks] = inside[breaks]
    starts = np.flatnonzero(start)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    lengths = np.diff(starts, append=len(data))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    power = np.cumprod(np.full(int(lengths.max()), _BASE))
    return starts, mix(np.add.reduceat(values[data[starts[0] :]] * power[place], starts - starts[0]))


def words_of(data: np.ndarray, offsets: np.ndarray, values: np.ndarray = SPACED) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, hash) of each word in order, with A-Z like a-z."""
    starts, hashes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data):  # move to the next separator or text start, whichever comes first
            stops = np.flatnonzero(values[data[end : end + PIECE]] == 0)
            border = int(offsets[np.searchsorted(offsets, end, "left")])
            stop = end + (int(stops[0]) if len(stops) else PIECE)
            found = len(stops) > 0 or stop >= border
            end = min(stop, border, len(data))
            if found:
                break
        inner = offsets[(offsets >= at) & (offsets < end)] - at
        s, h = _piece(data[at:end], inner, values)
        starts.append(s + at)
        hashes.append(h)
        at = end
    return np.concatenate(starts), np.concatenate(hashes)


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, values: np.ndarray = SPACED
) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, word offsets of the texts)."""
    starts, hashes = words_of(data, offsets, values)
    return hashes, np.searchsorted(starts, offsets).astype(np.int64)


_PLACE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE) | np.uint64(1)


def sequence_hash(words: np.ndarray, positions: list[int], length: int) -> np.ndarray:
    """Hash of the chosen positions in every window of ``length`` words; window i begins at word i."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for p in positions:
        total += words[p : p + n] * _PLACE[p]
    return mix(total + np.uint64(length))


def shingle_set(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Distinct shingles of one text, sorted; a text of fewer words is one shingle, none has none."""
    if len(words) == 0:
        return words
    if len(words) < width:
        return sequence_hash(words, list(range(len(words))), len(words))
    return np.unique(sequence_hash(words, list(range(width)), width))
