"""Token ids in fixed-width bit-packed files, with block offsets for random access.

A shard file holds, from its start: the packed blocks; the footer's arrays; a trailer of fixed size. A block
is ``BLOCK`` ids (the last one fewer), each in as many bits as the vocabulary needs, most significant bit
first, filled up to a whole byte. The footer lists the byte offset of each block, the place of each
document's first id in the shard, and the document ids with a mark for unknown ones.

Texts are encoded where they are read, and only their ids, in whole bytes, are shuffled to the shards. Each
shard is a range of (document id, first ``HEAD`` characters, hash of the text); a bounded sample of these keys
places the edges, and rows that are equal in all three may be dealt over several shards.

Shards are written by Spark tasks into the folder that the cluster shares, under a temporary name, and then
renamed; a repeated task writes the same bytes to the same name. Nothing but one manifest row per shard
comes back. Reading opens only the blocks it needs.

Defined cases: a null text is empty and encodes to the end id alone; a null document id comes first; rows
with equal ids are ordered by their first ``HEAD`` characters, then by a hash of the text; an empty table gives no
shard and no row; further columns are ignored; texts of any length are encoded whole, word by word, and blocks
bound what is held of them.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from contrail.llm.common import documents, lean, ship, stored
from contrail.llm.words import utf8
from contrail.session import shared_folder

BLOCK = 1 << 16
TRAILER = struct.Struct("<8sIIQQQQ")  # magic, bits, ids per block, blocks, documents, ids, footer offset
MAGIC = b"PACKIDS1"
CACHED_WORDS, CACHED_PARTS = 300_000, 900_000  # per Python worker; beyond them the caches start anew
HEAD = 32
SHARDS = 4  # for each shuffle partition, so that tasks that get several hold about as much as others
SAMPLED = 100_000  # keys, at about, that place the edges of the shards
MANIFEST = "shard int, path string, n_docs long, n_ids long"
_MARKS, _LATIN = b".,;:!?", 0x250


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def whole_bytes(bits: int) -> np.dtype:
    """The smallest type of whole bytes for ids of so many bits, most significant byte first."""
    return np.dtype(">u1" if bits <= 8 else ">u2" if bits <= 16 else ">u4")


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits == 8 * whole_bytes(bits).itemsize:
        return ids.astype(whole_bytes(bits)).tobytes()
    wide = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(wide[:, 32 - bits :].ravel()).tobytes()


def unpack(block: bytes, n: int, bits: int) -> np.ndarray:
    if bits == 8 * whole_bytes(bits).itemsize:
        return np.frombuffer(block, whole_bytes(bits), n).astype("<u4")
    wide = np.zeros((n, 32), np.uint8)
    wide[:, 32 - bits :] = np.unpackbits(np.frombuffer(block, np.uint8), count=n * bits).reshape(n, bits)
    return np.packbits(wide, axis=1).view(">u4").ravel().astype("<u4")


class _Cache(dict):
    """Values by a function of their key; it starts anew beyond ``most`` values."""

    def __init__(self, make: Callable, most: int):
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self.make(key)
        if len(self) >= self.most:
            self.clear()
        self[key] = value
        return value


class Encoder:
    """The library's ids of a text as little-endian 32-bit numbers.

    The tokenizer's pieces never contain white space, so a text's ids are those of its words in turn, and the
    ids of a word need to be asked for only once. Nor does a piece hold a letter and a mark, so marks that end a
    word are asked for apart from it. It takes letters in lower case, which for ASCII is done at once, unless
    the text might hold a special token. Words of Latin letters are one piece: they go to the tokenizer's model
    letter by letter as its normalizer and pre-tokenizer give them. ``whole`` says that all this doesn't hold
    for a tokenizer.
    """

    def __init__(self, path: str, whole: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.whole = self.tokenizer.model, whole
        self.words = _Cache(self._word, CACHED_WORDS)  # as they stand
        self.parts = _Cache(self._part, CACHED_PARTS)  # words without marks, and marks
        self.letters = _Cache(self._letter, _LATIN)

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _letter(self, code: int) -> str:
        """A Latin letter as the pieces have it, "" for anything else."""
        if code >= _LATIN or not chr(code).isalpha():
            return ""
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(chr(code)))
        return pieces[0][0] if len(pieces) == 1 else ""

    def _part(self, part: bytes) -> bytes:
        if not part:
            return b""
        text = part.decode()
        if part.isalpha() or all(map(self.letters.__getitem__, map(ord, text))):
            piece = text if part.isalpha() and part.islower() else text.translate(self.letters)
            return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()
        return self._ids(text)

    def _word(self, word: bytes) -> bytes:
        core = word.rstrip(_MARKS)
        if core == word or not core:
            return self.parts[word]
        if core[-1:].isalpha() or core[-1] >= 0x80 and self.letters[ord(core.decode()[-1])]:
            return self.parts[core] + self.parts[word[len(core) :]]
        return self.parts[word]

    def __call__(self, text: bytes) -> bytes:
        if self.whole:
            return self._ids(text.decode())
        return b"".join(map(self.words.__getitem__, (text if b"<|" in text else text.lower()).split()))


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, whole: bool = False) -> Encoder:
    """One per Python worker, however many tasks it runs."""
    if (path, whole) not in _ENCODERS:
        _ENCODERS[path, whole] = Encoder(path, whole)
    return _ENCODERS[path, whole]


class Writer:
    def __init__(self, uri: str, bits: int):
        self.files, self.path = fs.FileSystem.from_uri(uri)
        self.files.create_dir(self.path.rpartition("/")[0])
        self.temporary, self.bits = f"{self.path}.{uuid.uuid4().hex}.tmp", bits
        self.out = self.files.open_output_stream(self.temporary)
        self.waiting, self.n_waiting, self.size = [], 0, 0
        self.blocks, self.starts, self.doc_ids, self.n = [], [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.starts.append(self.n)
        self.doc_ids.append(doc_id)
        self.n += len(ids)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // BLOCK * BLOCK
            for i in range(0, whole, BLOCK):
                self._block(ids[i : i + BLOCK])
            self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def _block(self, ids: np.ndarray) -> None:
        packed = pack(ids, self.bits)
        self.blocks.append(self.size)
        self.out.write(packed)
        self.size += len(packed)

    def close(self) -> None:
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        unknown = np.array([d is None for d in self.doc_ids], np.uint8)
        numbers = np.array([0 if d is None else d for d in self.doc_ids], "<i8")
        self.out.write(np.array(self.blocks, "<u8").tobytes() + np.array(self.starts, "<u8").tobytes())
        self.out.write(numbers.tobytes() + unknown.tobytes())
        self.out.write(TRAILER.pack(MAGIC, self.bits, BLOCK, len(self.blocks), len(self.starts), self.n, self.size))
        self.out.close()
        self.files.move(self.temporary, self.path)


class Reader:
    """Random access to the ids of one shard."""

    def __init__(self, uri: str):
        files, path = fs.FileSystem.from_uri(uri)
        self.file = files.open_input_file(path)
        size = self.file.size()
        magic, self.bits, self.block, blocks, docs, self.n, end = TRAILER.unpack(
            self.file.read_at(TRAILER.size, size - TRAILER.size)
        )
        if magic != MAGIC:
            raise ValueError(f"{uri} is no file of packed ids")
        footer = self.file.read_at(8 * blocks + 17 * docs, end)
        self.offsets = np.append(np.frombuffer(footer, "<u8", blocks), np.uint64(end)).astype(np.int64)
        self.starts = np.append(np.frombuffer(footer, "<u8", docs, 8 * blocks), np.uint64(self.n)).astype(np.int64)
        numbers = np.frombuffer(footer, "<i8", docs, 8 * blocks + 8 * docs)
        unknown = np.frombuffer(footer, np.uint8, docs, 8 * blocks + 16 * docs)
        self.doc_ids = [None if u else int(d) for d, u in zip(numbers, unknown)]
        self._held: tuple[int, np.ndarray] = (-1, np.zeros(0, "<u4"))

    def _ids(self, block: int) -> np.ndarray:
        if self._held[0] != block:
            at, end = self.offsets[block], self.offsets[block + 1]
            n = min(self.block, self.n - block * self.block)
            self._held = block, unpack(self.file.read_at(int(end - at), int(at)), n, self.bits)
        return self._held[1]

    def pieces(self, i: int) -> Iterator[np.ndarray]:
        """The ids of the i-th document, block by block."""
        at, end = int(self.starts[i]), int(self.starts[i + 1])
        while at < end:
            block = at // self.block
            stop = min(end, (block + 1) * self.block)
            yield self._ids(block)[at - block * self.block : stop - block * self.block]
            at = stop

    def document(self, i: int) -> np.ndarray:
        return np.concatenate([np.zeros(0, "<u4"), *self.pieces(i)])


Key = tuple[bool, int, str, int]  # whether the id is known, the id, the text's first characters and hash


def _key(doc_id: int | None, head: str, text_hash: int) -> Key:
    return doc_id is not None, doc_id or 0, head, text_hash


class Dealer:
    """The shard of a key, given the edges between shards in ascending order.

    A key that is an edge may stand on either side of it, so its rows take turns; they are equal in id and text.
    """

    def __init__(self, edges: list[Key]):
        self.edges, self.turns = edges, Counter()

    def __call__(self, key: Key) -> int:
        first = bisect_left(self.edges, key)
        last = bisect_right(self.edges, key, first)
        if first == last:
            return first
        self.turns[key] += 1
        return first + self.turns[key] % (last - first + 1)


def _edges(rows: DataFrame, shards: int) -> list[Key]:
    """Keys that cut ``rows`` (doc_id, text, head, hash) into about equal ranges."""
    fraction = min(1.0, SAMPLED / max(1, rows.select("doc_id").count()))
    sample = rows.select("doc_id", "head", "hash").sample(fraction, seed=1).toLocalIterator()
    keys = sorted(_key(*row) for row in sample)
    return [keys[len(keys) * i // shards] for i in range(1, shards)] if keys else []


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, whole_texts: bool = False
) -> DataFrame:
    """Write ``docs`` (doc_id, text) in ascending order of doc_id; the manifest, one row per shard."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    ship(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = bits_for(max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1))
    text = F.coalesce("`text`", F.lit(""))
    rows = docs.select(
        F.col("`doc_id`").cast("long").alias("doc_id"), text.alias("text"),
        F.substring(text, 1, HEAD).alias("head"), F.xxhash64(text).alias("hash"),
    )
    edges = spark.sparkContext.broadcast(_edges(rows, SHARDS * parts))  # one key per shard

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, deal, kind = encoder(tokenizer_path, whole_texts), Dealer(edges.value), whole_bytes(bits)
        end = np.array([end_id], kind).tobytes()
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            keys = zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)))
            shard = pa.array([deal(_key(*key)) for key in keys], pa.int32())
            ids = [
                np.frombuffer(encode(data[at:to].tobytes()), "<u4").astype(kind).tobytes() + end
                for at, to in zip(offsets[:-1], offsets[1:])
            ]
            columns = [shard, batch.column(0), batch.column(2), batch.column(3), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["shard", "doc_id", "head", "hash", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, writer, rows = -1, None, []

        def close() -> None:
            if writer is not None:
                writer.close()
                rows.append((shard, f"{folder}/shard-{shard:07d}.ids", len(writer.starts), writer.n))

        for batch in batches:
            for to, doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if to != shard:
                    close()
                    shard, writer = to, Writer(f"{folder}/shard-{to:07d}.ids", bits)
                writer.add(doc_id, np.frombuffer(ids.as_buffer(), whole_bytes(bits)))
        close()
        if rows:
            types = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*rows), types)], ["shard", "path", "n_docs", "n_ids"]
            )

    ids = rows.mapInArrow(lean(encoded), "shard int, doc_id long, head string, hash long, ids binary")
    order = ["shard", F.col("doc_id").asc_nulls_first(), "head", "hash"]
    dealt = ids.repartition(parts, "shard").sortWithinPartitions(*order).select("shard", "doc_id", "ids")
    return stored(dealt.mapInArrow(lean(write), MANIFEST), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, shard, place) of every document, from the files alone."""
    # One row per shard: its ids' place among all comes from the sizes of the shards before.
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.select("shard", "path", F.coalesce(before, F.lit(0)).alias("before"))
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = Reader(row["path"])
                crc = np.zeros(len(reader.doc_ids), np.int64)
                for i in range(len(crc)):
                    value = 0
                    for ids in reader.pieces(i):
                        value = zlib.crc32(np.ascontiguousarray(ids, "<u4"), value)
                    crc[i] = value
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(reader.doc_ids, pa.int64()),
                        pa.array(reader.starts[:-1] + row["before"]),
                        pa.array(np.diff(reader.starts)),
                        pa.array(crc),
                        pa.array(np.full(n, row["shard"], np.int32)),
                        pa.array(np.arange(n)),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "shard", "place"],
                )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, place long"
    return shards.repartition(parts, "shard").mapInArrow(lean(read), schema)


def token_table(docs: DataFrame, tokenizer_path: str | None = None, end_id: int = 2) -> DataFrame:
    """Encode ``docs``, write their ids, and read them back; the files stay in the shared folder."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    folder = shared_folder(docs.sparkSession, "tokens")
    folder = folder if ":" in folder.split("/")[0] else f"file://{folder}"
    return read_token_files(write_token_files(docs, folder, tokenizer_path, end_id))


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_table(documents(spark, folder))
