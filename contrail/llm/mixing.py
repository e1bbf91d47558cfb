"""Mix sources to target weights by Pareto order sampling, with DataFrame functions only.

Every source gets a target in words (:func:`source_targets`). Inside a source each document expects
``min(most, c * weight)`` copies, ``c`` being such that the expected words meet the target. The whole part is
certain; the rest is the probability of one more copy. Those extra copies are drawn in the order of
``odds(u) / odds(p)``, u being a random number fixed by the document: the smallest come in until their words
fill what is left of the target, and a few last documents are those whose size comes nearest to the gap.

Nothing is sorted or summed by source in one task: ranks are cut into ``CELLS`` cells twice, words are
summed per cell, and only the one cell in which a source's target falls is ordered by row.

Defined cases: a null text, or one without words, has size 0 and is never taken; a null source is a source;
a null document id is an id of its own; rows that are equal in id, source and text are taken alike; an empty
table gives an empty mix; further columns are ignored; texts are counted whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from contrail.llm.common import (
    ROW_KEY,
    WORD,
    documents,
    join_checked,
    keyed,
    ranked,
    row_key,
    stored,
    unit_interval,
    unkeyed,
)

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3  # copies of a document
CELL_BITS, RANK_BITS = 10, 40
CELLS = 1 << CELL_BITS
CLOSING = 3  # documents that close the gap to a target, one after the other
SHORT, SHORT_WEIGHT = 50, 0.5  # documents under so many words get half the copies of others
UNIT = ["key", "doc_id", "text_hash"]


def words_in(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: str | Column) -> Column:
    """The source as a key that orders like it, null last, and joins with null as well."""
    source = F.col(source) if isinstance(source, str) else source
    return F.when(source.isNull(), F.lit("2")).otherwise(F.concat(F.lit("1"), source))


def _fill(df: DataFrame, group: str, total: str, room: str, weight: str, name: str) -> DataFrame:
    """Add ``name``: the group's ``total`` shared over its rows by weight, never more than their ``room``.

    What a full row leaves is shared again by the others, until none is above its room. ``df`` is small: one
    row per source, or one per source and weight class.
    """
    df = stored(df.withColumn("_full", F.col(room) <= 0), "shares")
    while True:
        full = F.col("_full")
        sums = df.groupBy(group).agg(
            F.sum(F.when(full, F.col(room)).otherwise(0.0)).alias("_held"),
            F.sum(F.when(full, 0.0).otherwise(F.col(weight))).alias("_open"),
        )
        level = F.try_divide((F.col(total) - F.col("_held")) * F.col(weight), "_open")
        shared = df.join(sums, group).withColumn(name, F.when(full, F.col(room)).otherwise(level))
        over = ~full & (F.col(name) >= F.col(room))
        shared = stored(shared.drop("_held", "_open").withColumn("_over", over), "shares")
        if shared.where("_over").isEmpty():
            return shared.drop("_full", "_over")
        df = shared.withColumn("_full", full | F.col("_over")).drop("_over", name)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(key, source_size, target) of the sources of ``sizes`` (key, size), see :func:`source_key`.

    Sources in order of their key weigh ``weights``, repeating. They share the words of all by weight; no
    target is above ``most`` times its source's words.
    """
    sources = stored(sizes.groupBy("key").agg(F.sum("size").alias("source_size")), "sources")
    placed = ranked(sources, [F.col("key")], "place")
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod("place", F.lit(len(weights))).cast("int"))
    words = placed.agg(F.sum("source_size")).first()[0] or 0
    shares = placed.select(
        "*", F.lit(0).alias("group"), F.lit(float(words)).alias("all"), weight.alias("weight"),
        (F.col("source_size") * most).cast("double").alias("room"),
    )
    return _fill(shares, "group", "all", "room", "weight", "target").select("key", "source_size", "target")


def _expected(classes: DataFrame, most: int) -> DataFrame:
    """(key, weight, expected): the copies that documents of a weight class expect, from (key, weight, size, target)."""
    pulls = classes.withColumn("room", (F.col("size") * most).cast("double"))
    filled = _fill(pulls.withColumn("pull", F.col("weight") * F.col("size")), "key", "target", "room", "pull", "words")
    copies = F.coalesce(F.try_divide(F.col("words"), F.col("size")), F.lit(0.0))
    return filled.select("key", "weight", F.least(F.lit(float(most)), copies).alias("expected"))


def _edge(rows: DataFrame, needs: DataFrame, bits: int) -> DataFrame:
    """(key, edge, before): the cell, by its leading ``bits``, in which a key's running words reach its need."""
    sums = rows.groupBy("key", F.shiftright("rank", RANK_BITS - bits).alias("edge")).agg(F.sum("words").alias("words"))
    upto = Window.partitionBy("key").orderBy("edge")  # at most CELLS rows a key
    run = join_checked(sums.withColumn("after", F.sum("words").over(upto)), needs, ["key"])
    before = F.col("after") - F.col("words")
    return run.where((before < F.col("need")) & (F.col("after") >= F.col("need"))).select(
        "key", "edge", before.alias("before")
    )


def _drawn(rows: DataFrame, needs: DataFrame) -> DataFrame:
    """``rows`` (key, rank, words, ...) with ``drawn``: whether a row is among those that fill its key's need."""
    coarse = stored(_edge(rows, needs, CELL_BITS), "edges")
    first = coarse.select("key", F.col("edge").alias("_cell"), F.col("before").alias("_words"))
    inside = join_checked(rows, stored(first, "edges"), ["key"])
    inside = inside.where(F.shiftright("rank", RANK_BITS - CELL_BITS) == F.col("_cell")).drop("_cell", "_words")
    rest = stored(needs.join(first, "key").select("key", (F.col("need") - F.col("_words")).alias("need")), "needs")
    fine = stored(_edge(inside, rest, 2 * CELL_BITS).withColumnRenamed("edge", "_fine"), "edges")

    # All of a source is drawn if it needs more than it has, nothing if it needs nothing.
    lot = needs.join(fine, "key", "left").join(rest.withColumnRenamed("need", "_rest"), "key", "left")
    marked = join_checked(rows, stored(lot, "lots"), ["key"])
    cell = F.shiftright("rank", RANK_BITS - 2 * CELL_BITS)
    plain = marked.where(F.col("_fine").isNull() | (cell != F.col("_fine")))
    below = F.when(F.col("_fine").isNull(), F.col("need") > 0).otherwise(cell < F.col("_fine"))
    # One of CELLS * CELLS cells of a source is ordered row by row.
    order = Window.partitionBy("key").orderBy("rank", F.col("doc_id").asc_nulls_first(), "text_hash")
    running = F.col("before") + F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0))
    tied = marked.where(cell == F.col("_fine")).withColumn("drawn", running <= F.col("_rest"))
    return plain.withColumn("drawn", below).unionByName(tied).drop("_fine", "before", "_rest")


def _closed(rows: DataFrame) -> DataFrame:
    """``rows`` with one more drawn per source: the one that brings the source nearest to its target, if any does."""
    got = F.sum(F.when(F.col("drawn"), F.col("words")).otherwise(0))
    gaps = stored(rows.groupBy("key").agg((F.max("need") - got).alias("gap")), "gaps")
    out = join_checked(rows.where(~F.col("drawn")), gaps, ["key"])
    out = out.withColumn("miss", F.abs(F.col("words") - F.col("gap"))).where(F.col("miss") < F.col("gap"))
    least = stored(out.groupBy("key").agg(F.min("miss").alias("least")), "misses")
    identity = F.struct("rank", F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("id"), "text_hash")
    last = join_checked(out, least, ["key"]).where("miss = least").groupBy("key").agg(F.min(identity).alias("closing"))
    marked = join_checked(rows, stored(last, "closing"), ["key"], "left")
    now = F.col("drawn") | F.coalesce(identity == F.col("closing"), F.lit(False))
    return marked.withColumn("drawn", now).drop("closing")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
    pull: Column | None = None,
    seed: str = "0",
) -> DataFrame:
    """(key, doc_id, text_hash, n, size, source_size, target, copies) of the distinct documents of ``docs``.

    ``n`` rows of ``docs`` are equal in all three; each is taken ``copies`` times. ``pull`` is a document's
    weight inside its source, a function of ``size`` with few different values; by default documents under
    ``SHORT`` words have ``SHORT_WEIGHT``, the others 1. Reruns give the same mix.
    """
    pull = F.when(F.col("size") < SHORT, SHORT_WEIGHT).otherwise(1.0) if pull is None else pull
    sized = docs.select(
        source_key("`source`").alias("key"), F.col("`doc_id`").alias("doc_id"),
        F.xxhash64("`text`").alias("text_hash"), words_in("`text`").alias("size"),
    )
    units = sized.groupBy(*UNIT).agg(F.max("size").alias("size"), F.count("*").alias("n"))
    units = stored(units.select("*", pull.cast("double").alias("weight"), (F.col("size") * F.col("n")).alias("words")), "units")

    targets = stored(source_targets(units.select("key", F.col("words").alias("size")), weights, most), "targets")
    classes = units.groupBy("key", "weight").agg(F.sum("words").alias("size")).join(targets.drop("source_size"), "key")
    expected = _expected(classes, most)
    # A shade under a whole number is that number; the closing document takes up what this changes.
    certain = F.floor(F.col("expected") + 1e-9)
    parameters = expected.join(targets, "key").withColumn("certain", certain)
    chance = F.when(F.col("expected") - F.col("certain") > 1e-9, F.col("expected") - F.col("certain"))
    parameters = stored(parameters.withColumn("chance", chance).drop("expected"), "parameters")

    identity = F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_hash").cast("string")
    odds = F.col("u") / (1 - F.col("u")) / (F.col("chance") / (1 - F.col("chance")))
    # An increasing function of the odds with values in (0, 1), spread rather evenly, as a whole number.
    rank = F.floor(odds / (1 + odds) * float(1 << RANK_BITS)).cast("long")
    rows = join_checked(units, parameters, ["key", "weight"]).withColumn("u", unit_interval(F.lit(seed), *identity))
    rows = stored(rows.withColumn("rank", F.when(F.col("size") > 0, rank)).drop("u", "chance", "weight"), "ranks")

    needs = rows.groupBy("key").agg((F.max("target") - F.sum(F.col("words") * F.col("certain"))).alias("need"))
    drawn = stored(_drawn(rows.where("rank IS NOT NULL"), stored(needs, "needs")), "drawn")
    for _ in range(CLOSING):
        drawn = stored(_closed(drawn), "drawn")
    drawn = drawn.withColumn("extra", F.col("drawn").cast("long")).drop("drawn", "need")
    rows = drawn.unionByName(rows.where("rank IS NULL").withColumn("extra", F.lit(0).cast("long")))
    copies = F.when(F.col("size") > 0, F.col("certain") + F.col("extra")).otherwise(0).cast("long")
    return rows.select(*UNIT, "n", "size", "source_size", "target", copies.alias("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` with each row as often as the mix takes it, all columns kept."""
    copies = mix(docs).where("copies > 0")
    copies = stored(copies.select("key", *row_key(F.col("doc_id"), F.col("text_hash")), "copies"), "copies")
    # A row for each document that is taken: Spark decides from its bytes, and splits a hot source, which is no key alone.
    rows = keyed(docs, None, source_key("`source`").alias("key")).join(copies, ["key", *ROW_KEY])
    return unkeyed(rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))), docs)


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mix(documents(spark, folder)).withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return rows.select("doc_id", "size", "source_size", "target", taken, "copies")
