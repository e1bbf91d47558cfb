"""Languages of a document as a mixture, inferred by expectation-maximisation.

A model holds, for each language, the probability of hashed byte 4-grams, counted over labelled texts. A
document's grams are seen as drawn from a mixture of languages; expectation-maximisation estimates the
proportions. The set of languages is chosen by penalised likelihood: a further language must raise the log
likelihood by more than half the logarithm of the number of grams. Every learned language is tried, those with the
largest proportions first, and sets may have any size. As neighbouring grams overlap, likelihoods
and counts are divided by the gram length. The prediction is the language with the largest proportion.

Labels: at most about ``TRAIN_DOCS`` texts for each language, chosen by a hash of the id. Text counts in lower
case, and everything but letters and non-ASCII bytes as one space.

Defined cases: a null text or one without letters is ``und`` with score 0, and so is every text if there are no
labels; a text of letters too short for a gram gets the language with the most labels and its share; a null id is
never held out nor learned from; very long texts are counted in pieces, all of them; repeated rows are judged
alike; rows keep all their columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pyspark.sql.types import DoubleType, MapType, StringType

from contrail.llm.common import documents, join_checked, lean, ship, small_batches, stored
from contrail.llm.words import PIECE, chunks, utf8

GRAM, BUCKETS = 4, 1 << 16
TRAIN_DOCS = 20_000  # for each language, on average
SMOOTHING = 0.5
AT_ONCE = 1 << 18  # bytes of texts whose languages are found together, which bounds a worker's temporary arrays
CELLS = 1 << 24  # grams x languages that are looked at in one go, unless a single text has more
STEPS = 8
TANGENT = 0.05  # a proportion, at which the gain of a second language is bounded
UNKNOWN = "und"

_LETTER = np.full(256, 0x20, np.uint8)
_LETTER[0x80:] = np.arange(0x80, 0x100)
_LETTER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1]


@dataclass
class Model:
    """``log_p``: languages x buckets; ``share``: how many of the labels a language has."""

    languages: list[str]
    log_p: np.ndarray
    share: np.ndarray


def padded(text: str | Column) -> Column:
    """What the grams are cut from."""
    return F.concat(F.lit(" "), F.lower(text), F.lit("  "))


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of all grams of some texts, in order of the texts."""
    letters = _LETTER[data]
    space = letters == 0x20
    keep = ~space
    keep[1:] |= ~space[:-1]
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    letters, offsets = letters[keep].astype(np.uint32), before[offsets]
    n = len(letters) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    code = np.zeros(n, np.uint32)
    for i in range(GRAM):
        code = code << np.uint32(8) | letters[i : i + n]
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.uint32), np.diff(offsets))[:n]
    inside = np.arange(n) + GRAM <= offsets[text.astype(np.int64) + 1]
    return text[inside], ((code * np.uint32(2654435761)) >> np.uint32(16))[inside]


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """As :func:`_grams`; a very long text comes in pieces."""
    if len(data) <= 2 * PIECE or len(offsets) > 2:
        yield _grams(data, offsets)
        return
    for at in range(0, len(data), PIECE):
        piece = data[at : at + PIECE + GRAM - 1]
        yield _grams(piece, np.array([0, len(piece)]))


def train(labelled: DataFrame) -> Model:
    """Count the grams of ``labelled`` (doc_id, text, lang); rows without a label or text are left out.

    Counts are summed by task, then by Spark; the driver gets ``BUCKETS`` numbers for each language at most.
    """
    ship(labelled.sparkSession)
    small_batches(labelled.sparkSession)
    known = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = stored(known.groupBy("lang").agg(F.count("*").alias("docs")), "languages")
    draw = F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1_000_000)) / 1_000_000
    some = join_checked(known, sizes, ["lang"]).where(draw < F.lit(float(TRAIN_DOCS)) / F.col("docs"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(1).to_pylist()
            data, offsets = utf8(batch.column(0))
            for first, last in chunks(offsets):
                part = offsets[first : last + 1]
                languages, code = np.unique(names[first:last], return_inverse=True)
                for text, bucket in _pieces(data[part[0] : part[-1]], part - part[0]):
                    both = code[text] * BUCKETS + bucket.astype(np.int64)
                    sums = np.bincount(both, minlength=len(languages) * BUCKETS).reshape(-1, BUCKETS)
                    for language, row in zip(languages, sums):
                        totals[str(language)] = totals.get(str(language), 0) + row
        for language, row in totals.items():
            at = np.flatnonzero(row)
            columns = [pa.array([language] * len(at)), pa.array(at.astype(np.int32)), pa.array(row[at])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "bucket", "n"])

    counted = some.select(padded("text").alias("text"), "lang").mapInArrow(lean(count), "lang string, bucket int, n long")
    found = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    docs = {r["lang"]: r["docs"] for r in sizes.collect()}
    languages = sorted(docs)
    counts = np.full((len(languages), BUCKETS), SMOOTHING)
    row = {language: i for i, language in enumerate(languages)}
    counts[[row[x] for x in found["lang"]], found["bucket"].to_numpy(np.int64)] += found["n"].to_numpy(float)
    share = np.array([docs[x] for x in languages], float)
    log_p = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    return Model(languages, log_p, share / max(share.sum(), 1))


def _sums(values: np.ndarray, begin: np.ndarray, dtype=None) -> np.ndarray:
    """Sums of the rows of each text; ``begin`` are their first rows."""
    return np.add.reduceat(values, begin, axis=0, dtype=dtype)


def _mixture(
    p: np.ndarray, n: np.ndarray, begin: np.ndarray, text: np.ndarray, total: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (texts x languages) and log likelihoods after ``STEPS`` steps.

    ``p``: grams x languages, relative to the gram's likeliest language; ``n``: how often a text has the gram.
    """
    theta = np.full((len(begin), p.shape[1]), 1 / p.shape[1], np.float32)
    for _ in range(STEPS):
        weighed = p * theta[text]
        weighed *= (n / weighed.sum(axis=1))[:, None]
        theta = _sums(weighed, begin) / total[:, None]
    return theta, _sums(n * np.log((p * theta[text]).sum(axis=1)), begin, np.float64)


def infer(model: Model, text: np.ndarray, bucket: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chosen languages, texts x languages, -1 for none; their proportions; certainty of the first) from all grams."""
    width = len(model.languages)
    chosen = np.full((texts, width), -1)
    share, sure = np.zeros((texts, width)), np.zeros(texts)
    both, n = np.unique(text.astype(np.int64) * BUCKETS + bucket, return_counts=True)
    if not len(both):
        return chosen, share, sure
    gram_text, gram = both // BUCKETS, both % BUCKETS
    n = n.astype(np.float32)
    begin = np.flatnonzero(np.diff(gram_text, prepend=-1))
    present, ends = gram_text[begin], np.append(begin[1:], len(both))
    at = 0
    while at < len(begin):
        to = max(at + 1, int(np.searchsorted(ends, begin[at] + CELLS // width, side="right")))
        some = slice(begin[at], ends[to - 1])
        found = _chosen(model, gram[some], n[some], begin[at:to] - begin[at])
        for result, values in zip((chosen, share, sure), found):
            result[present[at:to]] = values
        at = to
    return chosen, share, sure


def _may_gain(
    log_p: np.ndarray, n: np.ndarray, begin: np.ndarray, row: np.ndarray, best: np.ndarray, least: np.ndarray
) -> np.ndarray:
    """Whether a second language beside ``best`` might raise a text's log likelihood by more than ``least``.

    The likelihood is concave in the second one's proportion, so its tangents at 0 and at ``TANGENT`` bound it.
    """
    may = np.zeros(len(begin), bool)
    first = np.take_along_axis(log_p, best[row][:, None], axis=1)[:, 0]
    for second in range(log_p.shape[1]):
        more = np.exp(log_p[:, second] - first) - np.float32(1)
        at_zero = _sums(n * more, begin, np.float64)
        there = 1 + np.float32(TANGENT) * more
        height, slope = _sums(n * np.log(there), begin, np.float64), _sums(n * more / there, begin, np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            crossing = at_zero * (height - slope * TANGENT) / (at_zero - slope)
        bound = np.where(slope > 0, height + slope * (1 - TANGENT), crossing)
        may |= (best != second) & (at_zero > 0) & ~(bound <= 0.99 * least)
    return may


def _chosen(model: Model, gram: np.ndarray, n: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`infer`, for texts whose grams begin at ``begin``."""
    docs = np.arange(len(begin))
    row = np.repeat(docs, np.diff(begin, append=len(gram)))
    total = _sums(n, begin)
    log_p = model.log_p.T[gram]
    alone = _sums(n[:, None] * log_p, begin, np.float64)
    best = alone.argmax(axis=1)
    if alone.shape[1] > 1:
        two = -np.partition(-alone, 1, axis=1)[:, :2]
        sure = 1 / (1 + np.exp(np.clip((two[:, 1] - two[:, 0]) / GRAM, -50, 0)))
    else:
        sure = np.ones(len(docs))
    chosen, share = np.full(alone.shape, -1), np.zeros(alone.shape)
    chosen[:, 0], share[:, 0] = best, 1
    cost = 0.5 * np.log(np.maximum(total / GRAM, 2))  # of each further language
    open_ = np.flatnonzero(_may_gain(log_p, n, begin, row, best, GRAM * cost))
    if len(open_):
        number = np.full(len(docs), -1)
        number[open_] = np.arange(len(open_))
        mine = np.flatnonzero(number[row] >= 0)
        chosen[open_], share[open_] = _sets(log_p[mine], n[mine], number[row[mine]], alone[open_], cost[open_])
    return chosen, share, sure


def _sets(log_p: np.ndarray, n: np.ndarray, row: np.ndarray, alone: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chosen languages, their proportions) of texts, ``row`` being the text of a gram."""
    docs = np.arange(len(alone))
    begin = np.flatnonzero(np.diff(row, prepend=-1))
    total = _sums(n, begin)
    top = log_p.max(axis=1)
    p = np.exp(log_p - top[:, None])
    base = _sums(n * top, begin, np.float64)
    order = np.argsort(-_mixture(p, n, begin, row, total)[0], axis=1, kind="stable")
    best = alone.argmax(axis=1)
    score = alone[docs, best] / GRAM
    member = np.zeros(alone.shape, bool)
    member[docs, best] = True
    share = member.astype(float)

    # Each language in turn joins the set, or leaves it, where that raises the score; sets that changed are tried again.
    todo = docs
    while len(todo):
        changed = np.zeros(len(docs), bool)
        for language in order[todo].T:
            sizes = member[todo].sum(axis=1) + np.where(member[todo, language], -1, 1)
            for size in np.unique(sizes[sizes > 0]):
                some, turned = todo[sizes == size], language[sizes == size]
                sets = member[some]
                sets[np.arange(len(some)), turned] ^= True
                names = np.argsort(~sets, axis=1, kind="stable")[:, :size]
                number = np.full(len(docs), -1)
                number[some] = np.arange(len(some))
                mine = np.flatnonzero(number[row] >= 0)
                numbers = number[row[mine]]
                first = np.flatnonzero(np.diff(numbers, prepend=-1))
                theta, likely = _mixture(p[mine[:, None], names[numbers]], n[mine], first, numbers, total[some])
                value = (likely + base[some]) / GRAM - (size - 1) * cost[some]
                better = value > score[some]
                won = some[better]
                score[won], member[won], changed[won], share[won] = value[better], sets[better], True, 0
                share[won[:, None], names[better]] = theta[better]
        todo = np.flatnonzero(changed)
    at = np.argsort(np.where(member, -share, 1), axis=1, kind="stable")
    return np.where(np.take_along_axis(member, at, axis=1), at, -1), np.take_along_axis(share, at, axis=1)


def identified(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """(row, lang_pred, score, languages): ``keep``, else all, of each row of ``docs`` as a struct, with its language.

    ``languages`` maps the chosen set to proportions; ``score`` is the predicted language's proportion times the
    certainty that it beats the next one.
    """
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    row = F.struct(*(F.col(f"`{c}`") for c in keep or docs.columns)).alias("row")
    ready = docs.select(
        row, padded("`text`").alias("text"), F.coalesce(F.col("`text`").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    )
    schema = ready.select("row").schema.add("lang_pred", StringType()).add("score", DoubleType())
    schema = schema.add("languages", MapType(StringType(), DoubleType()))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            letters = batch.column(2).to_pylist()
            names, scores, sets = [], [], []
            data, offsets = utf8(batch.column(1))
            for first, last in chunks(offsets, AT_ONCE):
                part = offsets[first : last + 1]
                pieces = list(zip(*_pieces(data[part[0] : part[-1]], part - part[0])))
                text, bucket = (np.concatenate(x) for x in pieces)
                if not model.languages:
                    text, bucket = text[:0], bucket[:0]
                chosen, share, sure = infer(model, text, bucket, last - first)
                for i in range(last - first):
                    found = [(model.languages[c], float(s)) for c, s in zip(chosen[i], share[i]) if c >= 0]
                    if not letters[first + i] or not model.languages:
                        found, name, score = [], UNKNOWN, 0.0
                    elif not found:
                        most = int(model.share.argmax())
                        name, score = model.languages[most], float(model.share[most])
                    else:
                        name, score = found[0][0], min(1.0, found[0][1]) * float(sure[i])
                    names.append(name)
                    scores.append(score)
                    sets.append(found)
            columns = [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            columns.append(pa.array(sets, pa.map_(pa.string(), pa.float64())))
            yield pa.RecordBatch.from_arrays(columns, ["row", "lang_pred", "score", "languages"])

    return ready.mapInArrow(lean(predict), schema)


def held_out(doc_id: str, of: int, remainder: int) -> Column:
    checksum = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(checksum % of == remainder, F.lit(False))


def learned(docs: DataFrame) -> Model:
    """A model from the labels of ``docs`` outside the held-out third."""
    rows = docs.where(~held_out("`doc_id`", 3, 1) & F.col("`doc_id`").isNotNull())
    return train(rows.select(F.col("`doc_id`").alias("doc_id"), F.col("`text`").alias("text"), F.col("`lang`").alias("lang")))


def with_known_language(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text is in some language."""
    found = identified(docs, learned(docs)).where(F.col("lang_pred") != UNKNOWN)
    return found.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    found = identified(docs, learned(docs), keep=["doc_id"])
    mixture = F.array_join(F.transform(F.map_entries("languages"), lambda e: e["key"]), ",").alias("languages")
    return found.select("row.doc_id", held_out("row.doc_id", 3, 1).alias("held_out"), "lang_pred", "score", mixture)
