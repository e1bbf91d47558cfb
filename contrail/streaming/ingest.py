"""Period files as a stream: each file once, gated, stored by replacing its range.

A run takes what has arrived since the last one and stops (``availableNow``). The checkpoint remembers
the files taken; since every write replaces a whole range, a batch that Spark repeats after a failure
leaves the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, datetime
from heapq import heappop, heappush

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from contrail.functions.geo import DEFAULT_RESOLUTION
from contrail.functions.times import period_days, period_of
from contrail.operators.accumulate import STATE_SCHEMA, recounted
from contrail.operators.enrich import fct_events, int_events, int_measurements
from contrail.operators.flight_sets import NUMBERS, SETS, changed_cells, flight_sets, new_numbers, set_counts
from contrail.operators.hexagons import named
from contrail.operators.quality import Check, QualityError, day_failures, enforce_gate
from contrail.operators.skew import hot_keys
from contrail.operators.staging import stg_events, stg_measurements
from contrail.sources.schemas import GATED_COLUMNS
from contrail.sources.tables import read, read_or_empty, settled, store_days, store_ranges


def arrivals(
    spark: SparkSession, folder: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the files that land below ``folder``, oldest first, with the delivery each row came in.

    A delivery is a file in ``folder`` itself, or a folder of part files in it. ``arrived`` is when its file
    was written. Deliveries that wait together may come in one batch; see :func:`winners`.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    parts = F.split("_metadata.file_path", "/")
    above, root = F.element_at(parts, -2), folder.rstrip("/").rsplit("/", 1)[-1]
    delivery = F.when(above == root, F.element_at(parts, -1)).otherwise(above)
    return reader.parquet(folder).select(
        "*", delivery.alias(DELIVERY[0]), F.col("_metadata.file_modification_time").alias(DELIVERY[1])
    )


DELIVERY = ["delivery", "arrived"]


@dataclass
class Delivery:
    """A delivery's name, when it arrived, and the days of flight it ranges over."""

    name: str
    arrived: datetime
    first: date
    last: date


def winners(deliveries: list[Delivery], days: Iterable[date]) -> dict[date, str]:
    """For each day the last delivery that ranges over it.

    Taken one after the other, every delivery would replace its whole range. One sweep over the days, with the
    deliveries that have begun on a heap and the latest arrival on top, tells what would be left.
    """
    order = sorted(deliveries, key=lambda d: (d.arrived, d.name))
    begins = sorted((d.first, place) for place, d in enumerate(order))
    found: dict[date, str] = {}
    begun: list[int] = []
    at = 0
    for day in sorted(days):
        while at < len(begins) and begins[at][0] <= day:
            heappush(begun, -begins[at][1])
            at += 1
        while begun and order[-begun[0]].last < day:
            heappop(begun)
        if begun:
            found[day] = order[-begun[0]].name
    return found


def run_once(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> int:
    """Hand each pending batch to ``handle``, in order; gives the number of batches.

    An error in ``handle`` ends the run and the batch stays pending.
    """
    handled = []

    def counted(batch: DataFrame, batch_id: int) -> None:
        handle(batch, batch_id)
        handled.append(batch_id)

    query = (
        stream.writeStream.foreachBatch(counted)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(handled)


def event_batches(
    flights: DataFrame,
    measurements: DataFrame,
    facts_table: str,
    arrays_table: str | None = None,
    resolution: int = DEFAULT_RESOLUTION,
    gated: bool = False,
    checks: list[Check] | None = None,
) -> Callable[[DataFrame, int], None]:
    """Batch handler: gate, enrich and store raw events, then bring the metric arrays up to date.

    However many deliveries wait, the batch is enriched once, into the shared checkpoint folder, and stored in one
    change: each day gets the rows of the last delivery that ranges over it, as if they had come one after the
    other. Only the deliveries' names and ranges and the days reach the driver. Fails when a delivery has no
    event of a known flight, which means that the flights were not loaded yet. ``gated`` says that the batches have
    passed the gate already. The failures of ``checks`` are counted on the days that changed and kept by day in a
    table beside the facts.
    """

    def handle(raw: DataFrame, _batch_id: int) -> None:
        if not gated:
            enforce_gate(raw, GATED_COLUMNS["events"])
        if DELIVERY[0] not in raw.columns:
            raw = raw.withColumns({DELIVERY[0]: F.lit(""), DELIVERY[1]: F.lit(0).cast("timestamp")})
        known = int_events(stg_events(raw, *DELIVERY), flights)
        facts = settled(fct_events(known, int_measurements(stg_measurements(measurements))))
        name, arrived = DELIVERY
        ranges = facts.groupBy(name, "dof").agg(F.min(arrived).alias(arrived)).collect()  # a row per delivery and day
        found = {r[name] for r in ranges}
        if not found or {r[0] for r in raw.select(name).distinct().collect()} - found:
            raise QualityError("no event matches a flight: load the flights of the period first")
        deliveries = []
        for one in sorted(found):
            own = [r for r in ranges if r[name] == one]
            days = [r["dof"] for r in own]
            deliveries.append(Delivery(one, min(r[arrived] for r in own), min(days), max(days)))
        # One row per day.
        won = raw.sparkSession.createDataFrame(list(winners(deliveries, {r["dof"] for r in ranges}).items()), f"dof date, {name} string")
        rows = facts.join(F.broadcast(won), ["dof", name], "left_semi").drop(*DELIVERY)
        rows = rows.select([c for c in facts.columns if c not in DELIVERY])
        touched = store_ranges(rows, facts_table, [(d.first, d.last) for d in deliveries])
        stored = read(raw.sparkSession, facts_table)
        if checks:
            failures = day_failures(stored.where(F.col("dof").isin(touched)), checks)
            store_days(failures, checks_table(facts_table), touched)
        if arrays_table is not None:
            advance_arrays(stored, arrays_table, touched, resolution)

    return handle


def checks_table(facts_table: str) -> str:
    return f"{facts_table}_checks"


def advance_arrays(events: DataFrame, table: str, days: list[date], resolution: int = DEFAULT_RESOLUTION) -> None:
    """Bring the metric arrays up to date with the stored events of some days of flight.

    A flight counts for the period of its day of flight. Beside the arrays lie, day by day, the flights of each cell
    (``flight_sets``) and the flights' numbers. The sets of the given days are built anew and compared with the
    stored ones, and only cells with a difference are recounted. The sets are stored last: a run that stopped
    before finds the same differences again.
    """
    spark, of_days = events.sparkSession, F.col("dof").isin(days)
    numbers_table, sets_table = f"{table}_numbers", f"{table}_flights"
    events = events.where(of_days)
    known = read_or_empty(spark, numbers_table, _fields(NUMBERS)).where(of_days)
    numbers = settled(known.unionByName(new_numbers(events, known)))
    store_days(numbers, numbers_table, [])
    new = settled(flight_sets(events, numbers, hot_keys(events, "flight_id"), resolution))
    stored = read_or_empty(spark, sets_table, _fields(SETS))
    changed = settled(changed_cells(stored.where(of_days), new))
    periods = sorted({period_of(day) for day in days})
    if not changed.isEmpty():
        others = stored.where(_in_periods(periods) & ~of_days)
        counted = _cells_of(others, changed).unionByName(_cells_of(new, changed))
        by = ["year_start", "slot", "q", "r"]
        counts = changed.join(set_counts(counted), by, "left").withColumn("count", F.coalesce("count", F.lit(0).cast("bigint")))
        years = spark.createDataFrame([(date(year, 1, 1), slot + 1) for year, slot in periods], "year_start date, periods int")
        touched = sorted({date(year, 1, 1) for year, _ in periods})
        state = read_or_empty(spark, table, STATE_SCHEMA).where(F.col("year_start").isin(touched))
        now = recounted(state, named(counts, resolution, "year_start", "slot"), years)
        store_days(now, table, touched, "year_start")
    store_days(new, sets_table, days)


def _fields(columns: str) -> StructType:
    return StructType.fromDDL(columns)


def _in_periods(periods: list[tuple[int, int]]) -> Column:
    """Days of flight in any of the periods."""
    condition = F.lit(False)
    for first, last in (period_days(*one) for one in periods):
        condition = condition | F.col("dof").between(F.lit(first), F.lit(last))
    return condition


def _cells_of(sets: DataFrame, cells: DataFrame) -> DataFrame:
    return sets.join(cells.select("q", "r").distinct(), ["q", "r"], "left_semi").select(sets.columns)
