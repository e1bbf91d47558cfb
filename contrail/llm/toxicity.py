"""Toxicity by multiple-instance learning: sentences are scored, a document combines them by noisy-or.

A sentence's probability is a logistic function of its words; a document is toxic unless none of its
sentences is, so its probability is one minus the product of the sentences' opposites. Only documents carry
labels: the weights are found by gradient steps on the documents' likelihood, which also tells which
sentences offend (:func:`scored`, :func:`offending`).

The weights are fitted on a bounded sample of labelled documents, at most about ``TRAIN_DOCS`` of each label,
chosen by a hash of the id and weighed by how many each stands for. Words are hashed to ``BUCKETS`` weights;
only words whose share of the sample's toxic documents differs from that of the others by ``LEAST_Z`` standard
errors have one, else the weights would learn the sample by heart.

Defined cases: a null, empty or wordless text has no sentence and score 0; very long texts are scored whole;
with no labels, or labels of one kind only, the score is that of untrained weights or of that kind; rows with a
null id are scored, not learned from and not held out; labels that repeat or disagree count each; rows keep all
their columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType

from contrail.llm.common import documents, join_checked, ship, stored
from contrail.llm.language import held_out
from contrail.llm.words import LETTERED, chunks, utf8, words_of

BUCKETS = 1 << 18
TRAIN_DOCS = 10_000  # of each label, on average
LEAST_DOCS, LEAST_Z = 5, 5.0
STEPS, RATE, DECAY = 200, 0.1, 1e-3
START = -5.0  # a sentence's log odds before anything is learned

_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?\n"]] = True


@dataclass
class Model:
    weights: np.ndarray
    start: float


def _sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each word, first word, text and number of each sentence that has words).

    Numbers count the sentence ends before a sentence, in its text.
    """
    starts, hashes = words_of(data, offsets, LETTERED)
    ends = np.flatnonzero(_END[data])
    text = np.searchsorted(offsets, starts, "right") - 1
    number = np.searchsorted(ends, starts)
    new = (np.diff(text, prepend=-1) != 0) | (np.diff(number, prepend=-1) != 0)
    first = np.flatnonzero(new)
    before = np.searchsorted(ends, offsets[:-1])
    return (hashes & np.uint64(BUCKETS - 1)).astype(np.int32), first, text[first], number[first] - before[text[first]]


def _log_none(model: Model, bucket: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Logarithm of the probability that a sentence does not offend."""
    odds = model.start + np.add.reduceat(model.weights[bucket], first)
    return -np.logaddexp(0, odds)


def fit(labelled: DataFrame) -> Model:
    """Weights from ``labelled`` (doc_id, text, toxic), a bounded sample of which reaches the driver."""
    ship(labelled.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for begin, end in chunks(offsets):
                part = offsets[begin : end + 1]
                bucket, first, text, _ = _sentences(data[part[0] : part[-1]], part - part[0])
                words, sentences = [], []
                for i in range(end - begin):
                    mine = first[np.searchsorted(text, i) : np.searchsorted(text, i, "right")]
                    stop = first[np.searchsorted(text, i, "right")] if (text > i).any() else len(bucket)
                    words.append(bucket[mine[0] : stop].tobytes() if len(mine) else b"")
                    sentences.append((mine - mine[0]).astype(np.int32).tobytes() if len(mine) else b"")
                columns = [pa.array(words, pa.binary()), pa.array(sentences, pa.binary())]
                columns += [batch.column(i).slice(begin, end - begin) for i in (1, 2)]
                yield pa.RecordBatch.from_arrays(columns, ["words", "sentences", "toxic", "stands_for"])

    schema = "words binary, sentences binary, toxic int, stands_for double"
    rows = labelled.select("text", "toxic", "stands_for").mapInArrow(cut, schema).toPandas()
    rows = rows[rows["sentences"].str.len() > 0]
    start = Model(np.zeros(BUCKETS, np.float32), START)
    if not len(rows):
        return start
    words = [np.frombuffer(w, np.int32) for w in rows["words"]]
    sentences = [np.frombuffer(s, np.int32) for s in rows["sentences"]]
    toxic = rows["toxic"].to_numpy(float)
    telling = _telling([np.unique(w) for w in words], toxic > 0)
    first = np.concatenate([s + at for s, at in zip(sentences, np.cumsum([0, *map(len, words)]))])
    document = np.cumsum([0, *map(len, sentences)])[:-1]
    words = np.concatenate(words)
    sentence = np.repeat(np.arange(len(first)), np.diff(first, append=len(words)))
    known = telling[words]
    return _descend(words[known], sentence[known], len(first), document, toxic, rows["stands_for"].to_numpy())


def _telling(sets: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """The buckets whose words are clearly more, or less, common among toxic documents."""
    kind = np.repeat(toxic, [len(s) for s in sets])
    bucket = np.concatenate(sets)
    among = np.bincount(bucket[kind], minlength=BUCKETS), np.bincount(bucket[~kind], minlength=BUCKETS)
    docs = max(toxic.sum(), 1), max((~toxic).sum(), 1)
    share = (among[0] + among[1]) / len(sets)
    error = np.sqrt(share * (1 - share) * (1 / docs[0] + 1 / docs[1]))
    z = np.abs(among[0] / docs[0] - among[1] / docs[1]) / np.maximum(error, 1e-12)
    return (among[0] + among[1] >= LEAST_DOCS) & (z >= LEAST_Z)


def _descend(
    words: np.ndarray, sentence: np.ndarray, sentences: int, document: np.ndarray, toxic: np.ndarray, weight: np.ndarray
) -> Model:
    """Adam on the mean log likelihood of the documents; ``document`` is the first sentence of each."""
    kinds, word = np.unique(words, return_inverse=True)
    values = np.zeros(len(kinds) + 1)  # the last one starts every sentence
    values[-1] = START
    mean, square = np.zeros_like(values), np.zeros_like(values)
    lengths = np.diff(document, append=sentences)
    weight = weight / weight.sum()
    for step in range(1, STEPS + 1):
        odds = values[-1] + np.bincount(sentence, values[word], sentences)
        none = np.add.reduceat(-np.logaddexp(0, odds), document)
        offends = np.maximum(-np.expm1(none), 1e-12)
        # d/d odds of the log likelihood: the sentence's probability times this, for toxic and other documents.
        pull = weight * np.where(toxic > 0, np.exp(none) / offends, -1.0)
        slope = np.repeat(pull, lengths) * np.exp(-np.logaddexp(0, -odds))
        gradient = np.append(np.bincount(word, slope[sentence], len(kinds)), slope.sum())
        gradient[:-1] -= DECAY * values[:-1] / len(values)
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        values += RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-10)
    weights = np.zeros(BUCKETS, np.float32)
    weights[kinds] = values[:-1]
    return Model(weights, float(values[-1]))


def scored(docs: DataFrame, model: Model, keep: list[str] | None = None, with_text: bool = False) -> DataFrame:
    """(row, score, worst, worst_score[, worst_text]) of each row of ``docs``.

    ``worst`` is the number of the sentence, from 0 and counting sentence ends, with the highest probability,
    the first of equals; null where there is none.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)
    row = F.struct(*(F.col(f"`{c}`") for c in keep or docs.columns)).alias("row")
    ready = docs.select(row, F.col("`text`").alias("text"))
    schema = ready.select("row").schema.add("score", DoubleType()).add("worst", IntegerType())
    schema = schema.add("worst_score", DoubleType())
    if with_text:
        schema = schema.add("worst_text", StringType())

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            n = batch.num_rows
            none, worst, best = np.zeros(n), np.full(n, -1), np.zeros(n)
            data, offsets = utf8(batch.column(1))
            for begin, end in chunks(offsets):
                part = offsets[begin : end + 1]
                bucket, first, text, number = _sentences(data[part[0] : part[-1]], part - part[0])
                if not len(first):
                    continue
                log_none = _log_none(model, bucket, first)
                at = np.flatnonzero(np.diff(text, prepend=-1))
                rows = begin + text[at]
                none[rows] = np.add.reduceat(log_none, at)
                least = np.minimum.reduceat(log_none, at)
                found = np.flatnonzero(log_none == np.repeat(least, np.diff(at, append=len(text))))
                found = found[np.flatnonzero(np.diff(text[found], prepend=-1))]
                worst[rows], best[rows] = number[found], -np.expm1(least)
            columns = [batch.column(0), pa.array(-np.expm1(none)), pa.array(worst.astype(np.int32), mask=worst < 0)]
            columns.append(pa.array(best, mask=worst < 0))
            if with_text:
                columns.append(pa.array(_texts(data, offsets, worst), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    def _texts(data: np.ndarray, offsets: np.ndarray, worst: np.ndarray) -> list[str | None]:
        texts: list[str | None] = []
        for i, number in enumerate(worst):
            own = data[offsets[i] : offsets[i + 1]]
            ends = np.concatenate([[-1], np.flatnonzero(_END[own]), [len(own) - 1]])
            whole = own[ends[number] + 1 : ends[number + 1] + 1] if number >= 0 else None
            texts.append(None if whole is None else whole.tobytes().decode().strip())
        return texts

    return ready.mapInArrow(score, schema)


def offending(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """(row, score, worst, worst_score, worst_text) of the documents that score ``least`` or more."""
    return scored(docs, model, with_text=True).where(F.col("score") >= least)


def learned(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from the labels outside the held-out fifth.

    Sampled labels are few, by ``TRAIN_DOCS``, so it is them that are sent to the documents.
    """
    known = labels.select(F.col("`doc_id`").alias("doc_id"), F.col("`toxic`").cast("int").alias("toxic"))
    known = known.where(~held_out("doc_id", 5, 0) & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    sizes = stored(known.groupBy("toxic").agg(F.count("*").alias("n")), "labels")
    draw = F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    share = F.least(F.lit(1.0), F.lit(float(TRAIN_DOCS)) / F.col("n"))
    some = join_checked(known, sizes, ["toxic"]).where(draw < share)
    some = stored(some.select("doc_id", "toxic", (1 / share).alias("stands_for")), "sample")
    texts = docs.select(F.col("`doc_id`").alias("doc_id"), F.col("`text`").alias("text"))
    return fit(join_checked(texts, some, ["doc_id"]))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    model = learned(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = scored(docs, model, keep=["doc_id"])
    return rows.select(
        "row.doc_id", held_out("row.doc_id", 5, 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "worst", "worst_score",
    )
