import random
from datetime import date

from helpers import at, events, rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from contrail.operators import accumulate, flight_sets as sets, hexagons, trajectory
from contrail.session import empty_frame
from contrail.sources.tables import read, store_range
from contrail.streaming.ingest import Delivery, advance_arrays, winners


def nothing(spark, columns):
    return empty_frame(spark, StructType.fromDDL(columns))


def sample(spark, seed, days=range(1, 25), flights=150):
    """Events of flights that each have one day of flight, some after midnight."""
    generator, entries = random.Random(seed), []
    for flight in range(flights):
        day = generator.choice(list(days))
        for i in range(generator.randrange(1, 5)):
            hour = generator.randrange(20 * 3600, 30 * 3600)
            entries.append((f"{flight:04}{i}", f"f{flight:04}", "landing", at(hour, day), generator.uniform(5, 6), generator.uniform(47, 48), 100, day))
    df = events(spark, *(e[:7] for e in entries))
    days = spark.createDataFrame(sorted({(e[1], date(2024, 1, e[7])) for e in entries}), "flight_id string, dof date")
    return df.join(days, "flight_id").select(*df.columns, "dof")


def no_hot(spark):
    return spark.createDataFrame([], "flight_id string, pieces bigint")


def built(spark, df, numbers=None):
    numbers = sets.new_numbers(df, nothing(spark, sets.NUMBERS)) if numbers is None else numbers
    return sets.flight_sets(df, numbers, no_hot(spark), 6)


def full(df):
    legs = trajectory.airborne(trajectory.legs(df, carried=["dof"]))
    return accumulate.metric_arrays(hexagons.period_counts(legs), accumulate.loaded_periods(df))


def test_numbers_are_dense_and_stay(spark):
    df = sample(spark, 1)
    first = df.where(F.col("flight_id") < "f0100")
    known = spark.createDataFrame(sets.new_numbers(first, nothing(spark, sets.NUMBERS)).collect(), sets.NUMBERS)
    both = known.unionByName(sets.new_numbers(df, known)).collect()
    by_day = {}
    for r in both:
        by_day.setdefault(r.dof, []).append(r.number)
    assert all(sorted(n) == list(range(len(n))) for n in by_day.values())
    assert len(both) == df.select("flight_id").distinct().count()
    assert sets.new_numbers(df, spark.createDataFrame(both, sets.NUMBERS)).isEmpty()


def test_a_large_day_is_numbered_in_pieces(spark):
    df = sample(spark, 2, days=[3])
    found = sets.new_numbers(df, nothing(spark, sets.NUMBERS), piece_flights=20).collect()
    pieces = {}
    for r in found:
        pieces.setdefault(r.number >> 32, []).append(r.number & 0xFFFFFFFF)
    assert len(pieces) > 4 and all(sorted(n) == list(range(len(n))) for n in pieces.values())


def test_set_counts_equal_distinct_counts(spark):
    df = sample(spark, 3)
    legs = trajectory.airborne(trajectory.legs(df, carried=["dof"]))
    counted = hexagons.named(sets.set_counts(built(spark, df)), 6, "year_start", "slot")
    assert rows(counted, "hex", "year_start", "slot", "count") == rows(hexagons.period_counts(legs), "hex", "year_start", "slot", "count")
    assert rows(sets.set_traffic(built(spark, df), 6)) == rows(hexagons.hex_traffic(legs))


def test_sets_of_parts_merge_to_those_of_the_whole(spark):
    df = sample(spark, 4)
    numbers = sets.new_numbers(df, nothing(spark, sets.NUMBERS))
    even = F.substring("flight_id", -1, 1).isin("0", "2", "4", "6", "8")
    parts = [built(spark, df.where(part), numbers) for part in (even, ~even)]
    columns = ["dof", "q", "r", "word", "bits"]
    assert rows(sets.merged(*parts, parts[0]), *columns) == rows(built(spark, df, numbers), *columns)


def test_only_cells_with_other_flights_change(spark):
    df = sample(spark, 5)
    numbers = sets.new_numbers(df, nothing(spark, sets.NUMBERS))
    old, new = built(spark, df, numbers), built(spark, df.where("flight_id <> 'f0007'"), numbers)
    own = hexagons.path_cells(trajectory.legs(df.where("flight_id = 'f0007'")), 6).select("q", "r").distinct()
    assert rows(sets.changed_cells(old, new), "q", "r") == rows(own, "q", "r") != []
    assert sets.changed_cells(old, old).isEmpty()


def test_stored_arrays_equal_one_pass_after_every_delivery(spark, database):
    facts, arrays = f"{database}.facts", f"{database}.arrays"
    whole = sample(spark, 6, days=range(1, 25), flights=80)
    moved = whole.withColumn("longitude", F.when(F.col("flight_id") < "f0010", F.col("longitude") + 0.3).otherwise(F.col("longitude")))
    deliveries = [
        whole.where("day(dof) <= 10"),
        whole.where("day(dof) > 10 AND day(dof) <= 22"),
        moved.where("day(dof) <= 5"),  # late, with other positions
        moved.where("day(dof) IN (11, 22) AND flight_id > 'f0040'"),  # days between lose their flights
        whole.where("day(dof) > 20"),
    ]
    for batch in deliveries:
        days = store_range(batch, facts)
        advance_arrays(read(spark, facts), arrays, days)
        assert rows(read(spark, arrays), "hex", "year_start", "metric_array") == rows(full(read(spark, facts)))
    before = read(spark, arrays).inputFiles()
    advance_arrays(read(spark, facts), arrays, days)
    assert read(spark, arrays).inputFiles() == before  # nothing differs, nothing is written


def test_a_stopped_run_is_made_up_for(spark, database, monkeypatch):
    facts, arrays = f"{database}.facts", f"{database}.arrays"
    whole = sample(spark, 7, flights=40)
    days = store_range(whole.where("day(dof) < 15"), facts)
    advance_arrays(read(spark, facts), arrays, days)
    days = store_range(whole.where("day(dof) >= 10"), facts)
    from contrail.streaming import ingest

    store_days, calls = ingest.store_days, []

    def stopping(*given):
        calls.append(given[1])
        if len(calls) == 3:  # the numbers, the arrays, the sets
            raise RuntimeError("stopped")
        return store_days(*given)

    with monkeypatch.context() as patch:
        patch.setattr(ingest, "store_days", stopping)
        try:
            advance_arrays(read(spark, facts), arrays, days)
        except RuntimeError:
            pass
    assert len(calls) == 3
    advance_arrays(read(spark, facts), arrays, days)
    assert rows(read(spark, arrays), "hex", "year_start", "metric_array") == rows(full(read(spark, facts)))


def test_the_last_delivery_over_a_day_wins():
    generator = random.Random(8)
    for _ in range(200):
        deliveries = []
        for i in range(generator.randrange(1, 8)):
            first = generator.randrange(1, 25)
            deliveries.append(Delivery(f"d{i}", at(generator.randrange(5)), date(2024, 1, first), date(2024, 1, generator.randrange(first, 29))))
        days = [date(2024, 1, d) for d in generator.sample(range(1, 32), 20)]
        left = {}
        for one in sorted(deliveries, key=lambda d: (d.arrived, d.name)):
            left |= {d: one.name for d in days if one.first <= d <= one.last}
        assert winners(deliveries, days) == left
