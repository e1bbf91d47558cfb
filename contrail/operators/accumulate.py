"""One array of counts per cell and year, a slot per 10-day period."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from contrail.functions.arrays import padded, total, unquoted, zeros
from contrail.functions.times import PERIOD_DAYS, period_slot, year_start

STATE_SCHEMA = StructType().add("hex", "string").add("year_start", "date").add("metric_array", ArrayType(LongType()))
SLOTS_PER_YEAR = 366 // PERIOD_DAYS + 1


def accumulate(previous: DataFrame, current: DataFrame, year: date, slot: int | None = None) -> DataFrame:
    """The year's state after one more period.

    ``previous`` is the state (hex, year_start, metric_array), ``current`` the period's (hex, count).
    Without ``slot`` the count is appended: a new cell gets zeros for the periods before, a cell
    without traffic a zero. With ``slot`` the count goes to that position, so a second run of the same
    period replaces its first.
    """
    state = previous.where(F.col("year_start") == F.lit(year)).select("hex", "metric_array")
    longest = F.coalesce(state.agg(F.max(F.size("metric_array"))).scalar(), F.lit(0))
    both = current.select("hex", "count").join(state, "hex", "full_outer")
    array, count = F.col("metric_array"), F.coalesce("count", F.lit(0).cast("bigint"))
    if slot is None:
        grown = F.array_append(F.coalesce(array, zeros(longest)), count)
    else:
        whole = padded(array, F.greatest(longest, F.lit(slot + 1)))
        grown = F.concat(
            F.slice(whole, 1, slot),
            F.array(count),
            F.slice(whole, F.lit(slot + 2), F.size(whole)),
        )
    return both.select("hex", F.lit(year).alias("year_start"), grown.alias("metric_array"))


def loaded_periods(events: DataFrame) -> DataFrame:
    """Number of period slots per year: up to the last one whose flights have events."""
    return events.groupBy(year_start(F.col("dof")).alias("year_start")).agg(
        (F.max(period_slot(F.col("dof"))) + 1).alias("periods")
    )


def metric_arrays(counts: DataFrame, periods: DataFrame) -> DataFrame:
    """The state that running ``accumulate`` over all periods ends with, in one pass.

    ``counts`` is (hex, year_start, slot, count), ``periods`` (year_start, periods). Each slot is a
    conditional sum, which aggregates before the shuffle; no list is gathered.
    """
    per_slot = [
        F.coalesce(F.sum(F.when(F.col("slot") == i, F.col("count"))), F.lit(0)).alias(f"slot_{i}")
        for i in range(SLOTS_PER_YEAR)
    ]
    wide = counts.groupBy("hex", "year_start").agg(*per_slot)
    slots = F.array(*(f"slot_{i}" for i in range(SLOTS_PER_YEAR)))
    # One row per calendar year, and a date has at most 9999 of them.
    return wide.join(F.broadcast(periods), "year_start").select(
        "hex", "year_start", F.slice(slots, F.lit(1), F.col("periods")).alias("metric_array")
    )


def recounted(state: DataFrame, counts: DataFrame, periods: DataFrame) -> DataFrame:
    """The state after counting some cells of some periods anew.

    ``counts`` is (hex, year_start, slot, count), ``periods`` (year_start, periods) says how many slots years have by
    now. All arrays of a year are as long as the longest of them or its periods, and cells without any flight
    have no row, so that the result is what ``metric_arrays`` gives for all counts.
    """
    entry = F.struct("slot", "count")
    # At most as many entries as a year has slots.
    new = counts.groupBy("hex", "year_start").agg(F.map_from_entries(F.collect_list(entry)).alias("new"))
    lengths = state.select("year_start", F.size("metric_array").alias("periods")).unionByName(periods)
    lengths = lengths.groupBy("year_start").agg(F.max("periods").alias("periods"))
    # A row for each year.
    both = state.join(new, ["hex", "year_start"], "full_outer").join(F.broadcast(lengths), "year_start")
    whole = padded(F.col("metric_array"), F.col("periods"))
    array = F.transform(whole, lambda old, slot: F.coalesce(F.try_element_at(F.col("new"), slot), old))
    return both.select("hex", "year_start", array.alias("metric_array")).where(F.exists("metric_array", lambda n: n > 0))


def sum_yearly_metric_array(state: DataFrame) -> DataFrame:
    return state.select(unquoted(F.col("hex")).alias("hex"), total(F.col("metric_array")).alias("count"))
