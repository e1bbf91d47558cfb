"""Which flights crossed a cell on a day, as bitmaps that merge.

Every flight has a number within its day of flight, from 0 without gaps, and keeps it. A row (dof, q, r, word,
bits) says which of the 64 flights of that word crossed the cell: bitmaps in pieces as long as a machine word, of
which only those exist that have a flight. Pieces of two deliveries are merged by ``bit_or`` and counted by
``bit_count``, both in generated code and with a partial aggregation before the shuffle; no list of flights is
gathered. As a flight belongs to one day, counts of days add up to distinct flights of any longer time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from contrail.functions.times import period_slot, year_start
from contrail.operators.hexagons import named, path_cells
from contrail.operators.skew import split_join
from contrail.operators.trajectory import airborne, legs

PIECE_FLIGHTS = 1_000_000  # flights of a day that are numbered in one task
NUMBERS = "dof date, flight_id string, number bigint"
SETS = "dof date, q bigint, r bigint, word bigint, bits bigint"
_KEY = ["dof", "q", "r", "word"]


def new_numbers(events: DataFrame, known: DataFrame, piece_flights: int = PIECE_FLIGHTS) -> DataFrame:
    """(dof, flight_id, number) of the flights of ``events`` that ``known`` has no number for.

    The flights of a very large day are numbered in several pieces; a number's upper half names the piece.
    """
    flights = events.select("dof", "flight_id").distinct().join(known, ["dof", "flight_id"], "left_anti")
    # A row for each day, at most as many as the calendar has.
    days = F.broadcast(flights.groupBy("dof").agg(F.ceil(F.count("*") / piece_flights).alias("pieces")))
    placed = flights.join(days, "dof").select("dof", "flight_id", F.pmod(F.xxhash64("flight_id"), "pieces").alias("piece"))
    piece = F.shiftright("number", 32)
    used = known.groupBy("dof", piece.alias("piece")).agg((F.max("number") - F.shiftleft(F.max(piece), 32) + 1).alias("used"))
    place = F.row_number().over(Window.partitionBy("dof", "piece").orderBy("flight_id")) - 1
    number = F.shiftleft("piece", 32) + F.coalesce("used", F.lit(0)) + F.col("place")
    ranked = placed.withColumn("place", place).join(used, ["dof", "piece"], "left")
    return ranked.select("dof", "flight_id", number.alias("number"))


def flight_sets(events: DataFrame, numbers: DataFrame, hot: DataFrame, resolution: int) -> DataFrame:
    """The sets (``SETS``) of the airborne legs of ``events``, which have a day of flight each."""
    named_flights = numbers.select(F.col("flight_id").alias("flight_key"), F.col("dof").alias("flight_dof"), "number")
    numbered = split_join(events, named_flights, {"flight_id": "flight_key", "dof": "flight_dof"}, hot, ["id"])
    cells = path_cells(airborne(legs(numbered, hot, carried=["dof", "number"])), resolution, "dof", "number")
    word = F.shiftright("number", 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("number").bitwiseAND(F.lit(63)).cast("int"))
    return cells.groupBy("dof", "q", "r", word.alias("word")).agg(F.bit_or(bit).alias("bits"))


def merged(*sets: DataFrame) -> DataFrame:
    """The union of sets of flights."""
    both = sets[0]
    for more in sets[1:]:
        both = both.unionByName(more)
    return both.groupBy(*_KEY).agg(F.bit_or("bits").alias("bits"))


def changed_cells(old: DataFrame, new: DataFrame) -> DataFrame:
    """(year_start, slot, q, r) of the cells whose flights differ on some day."""
    pairs = old.withColumnRenamed("bits", "before").join(new.withColumnRenamed("bits", "after"), _KEY, "full_outer")
    differing = pairs.where(~F.col("before").eqNullSafe(F.col("after")))
    return differing.select(year_start(F.col("dof")).alias("year_start"), period_slot(F.col("dof")).alias("slot"), "q", "r").distinct()


def set_counts(sets: DataFrame) -> DataFrame:
    """(year_start, slot, q, r, count): distinct flights per cell and 10-day period."""
    by = [year_start(F.col("dof")).alias("year_start"), period_slot(F.col("dof")).alias("slot"), "q", "r"]
    return sets.groupBy(*by).agg(F.sum(F.bit_count("bits").cast("bigint")).alias("count"))


def set_traffic(sets: DataFrame, resolution: int) -> DataFrame:
    """Distinct flights per cell over all days of ``sets``."""
    return named(sets.groupBy("q", "r").agg(F.sum(F.bit_count("bits").cast("bigint")).alias("count")), resolution)
