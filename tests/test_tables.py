from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from contrail.operators import accumulate, incremental
from contrail.session import empty_frame
from contrail.sources import tables


def facts(spark, *entries):
    return spark.createDataFrame([(i, d and date(2024, *d)) for i, d in entries], "id string, dof date")


def stored(spark, table):
    return rows(spark.table(table), "id", "dof")


def test_stored_range_equals_the_operator(spark, database):
    table = f"{database}.facts"
    first = facts(spark, ("a", (1, 1)), ("b", (1, 2)), ("c", (1, 3)), ("d", (1, 4)), ("e", (1, 5)))
    batch = facts(spark, ("x", (1, 2)), ("y", (1, 4)))
    tables.store_range(first, table)
    for _ in range(2):
        tables.store_range(batch, table)
        assert stored(spark, table) == rows(incremental.replace_range(first, batch))


def test_empty_batch_and_missing_day(spark, database):
    table = f"{database}.facts"
    tables.store_range(facts(spark, ("a", (1, 1))), table)
    tables.store_range(facts(spark), table)
    with pytest.raises(ValueError):
        tables.store_range(facts(spark, ("b", None)), table)
    assert stored(spark, table) == [("a", date(2024, 1, 1))]


def test_stored_months_equal_the_operator(spark, database):
    table = f"{database}.flights"
    first = facts(spark, ("a", (1, 1)), ("b", (1, 2)), ("c", (2, 3)), ("d", (3, 4)))
    batch = facts(spark, ("x", (1, 2)), ("y", (2, 9)))
    tables.store_months(first, table)
    for _ in range(2):
        tables.store_months(batch, table)
        assert stored(spark, table) == rows(incremental.replace_month(first, batch))


def test_drift_fails_and_leaves_the_table(spark, database):
    table = f"{database}.facts"
    tables.store_range(facts(spark, ("a", (1, 1))), table)
    drifted = facts(spark, ("b", (1, 1))).selectExpr("id", "dof", "1 AS more")
    with pytest.raises(incremental.SchemaDrift):
        tables.store_range(drifted, table)
    assert stored(spark, table) == [("a", date(2024, 1, 1))]


def test_day_filter_reads_one_partition(spark, database):
    table = f"{database}.facts"
    tables.store_range(facts(spark, ("a", (1, 1)), ("b", (1, 2))), table)
    plan = spark.table(table).where("dof = DATE '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dof" in plan


def pairs(spark, *entries):
    return spark.createDataFrame([(k, date(y, 1, 1), v) for k, y, v in entries], "k string, year date, v int")


def test_merge_rewrites_the_touched_partitions(spark, database):
    table = f"{database}.merged"
    tables.store_merge(pairs(spark, ("a", 2023, 1), ("b", 2024, 2)), table, ["k", "year"], ["v"], "year")
    tables.store_merge(pairs(spark, ("b", 2024, 3), ("c", 2024, 4)), table, ["k", "year"], ["v"], "year")
    assert rows(spark.table(table), "k", "v") == [("a", 1), ("b", 3), ("c", 4)]
    with pytest.raises(ValueError):
        tables.store_merge(pairs(spark), table, ["k"], ["v"], "year")


def test_periods_advance_and_a_rerun_replaces(spark, database):
    table = f"{database}.arrays"

    def period(year, slot, **counts):
        current = spark.createDataFrame(list(counts.items()), "hex string, count bigint")
        tables.store_period(current, table, date(year, 1, 1), slot)

    period(2024, 0, a=1, b=2)
    period(2024, 1, a=3, c=4)
    period(2024, 1, a=5)
    period(2025, 0, a=9)
    state = {(r.hex, r.year_start.year): r.metric_array for r in spark.table(table).collect()}
    # A cell that only the replaced run had keeps a row of zeros.
    assert state == {("a", 2024): [1, 5], ("b", 2024): [2, 0], ("c", 2024): [0, 0], ("a", 2025): [9]}


def test_before_the_first_run_the_state_is_empty(spark, database):
    empty = tables.read_or_empty(spark, f"{database}.none", accumulate.STATE_SCHEMA)
    assert empty.schema == accumulate.STATE_SCHEMA and empty.isEmpty()


def snapshot_run(spark, table, name, moment):
    current = spark.createDataFrame([(1, name)], "id int, name string")
    history = tables.read_or_empty(spark, table, incremental.scd2_columns(current.schema))
    tables.replace(incremental.scd2(history, current, "id", ["name"], moment), table)


def test_snapshot_is_replaced_by_rows_computed_from_it(spark, database):
    table = f"{database}.snapshot"
    snapshot_run(spark, table, "a", datetime(2024, 1, 1))
    snapshot_run(spark, table, "b", datetime(2024, 1, 11))
    assert rows(spark.table(table), "name", "dbt_valid_to") == [("a", datetime(2024, 1, 11)), ("b", None)]


class Stopped(Exception):
    pass


STEPS = ["_clean", "_append", "_list", "_switch"]


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("step", STEPS)
def test_a_run_stopped_at_any_step_leaves_the_old_rows_or_the_new(spark, database, monkeypatch, step, after):
    table = f"{database}.facts"
    first = facts(spark, ("a", (1, 1)), ("b", (1, 2)), ("c", (1, 3)), ("d", (1, 4)))
    batch = facts(spark, ("x", (1, 2)), ("y", (1, 4)), ("z", (1, 5)))
    tables.store_range(first, table)
    old, new = rows(first), rows(incremental.replace_range(first, batch))
    whole = getattr(tables, step)

    def stopping(*given):
        if after:
            whole(*given)
        raise Stopped

    with monkeypatch.context() as patch:
        patch.setattr(tables, step, stopping)
        with pytest.raises(Stopped):
            tables.store_range(batch, table)
    done = step == "_switch" and after
    assert stored(spark, table) == (new if done else old)
    for _ in range(2):  # the next run is complete, and drops what the stopped one left
        tables.store_range(batch, table)
        assert stored(spark, table) == new
    valid = tables._valid_pairs(spark, table)
    tables._clean(spark, table, "dof")
    assert sorted(tables._value(v) for v, _ in tables._stored_pairs(spark, table)) == sorted(v for v, _ in valid)
    assert len(tables._beside(spark, table, "parts")) == 1


def test_a_stop_while_rows_are_written(spark, database):
    """Tasks that fail, and a day that is missing, leave the table as it was and don't disturb the next run."""
    table = f"{database}.facts"
    first = facts(spark, ("a", (1, 1)), ("b", (1, 2)))
    tables.store_range(first, table)
    failing = first.withColumn("id", F.when(F.col("id") == "b", F.raise_error(F.lit("stop"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="stop"):
        tables.store_range(failing, table)
    with pytest.raises(ValueError):
        tables.store_range(facts(spark, ("x", (1, 1)), ("y", None)), table)
    assert stored(spark, table) == rows(first)
    tables.store_range(facts(spark, ("z", (1, 2))), table)
    assert stored(spark, table) == [("a", date(2024, 1, 1)), ("z", date(2024, 1, 2))]


@pytest.mark.parametrize("after", [False, True])
def test_a_stopped_replacement_of_a_whole_table(spark, database, monkeypatch, after):
    table = f"{database}.snapshot"
    snapshot_run(spark, table, "a", datetime(2024, 1, 1))
    whole = tables._switch

    def stopping(*given):
        if after:
            whole(*given)
        raise Stopped

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_switch", stopping)
        with pytest.raises(Stopped):
            snapshot_run(spark, table, "b", datetime(2024, 1, 11))
    assert spark.table(table).count() == 1 + after
    snapshot_run(spark, table, "b", datetime(2024, 1, 11))
    assert rows(spark.table(table), "name", "dbt_valid_to") == [("a", datetime(2024, 1, 11)), ("b", None)]
    snapshot_run(spark, table, "b", datetime(2024, 1, 12))
    assert len(tables._beside(spark, table, "whole")) == 2  # the state that readers see and the one before


def test_readers_of_the_state_before_can_finish(spark, database):
    table = f"{database}.facts"
    tables.store_range(facts(spark, ("a", (1, 1)), ("b", (1, 2))), table)
    reader = spark.table(table)
    tables.store_range(facts(spark, ("x", (1, 1)), ("y", (1, 2))), table)
    assert rows(reader, "id") == [("a",), ("b",)]
    assert rows(spark.table(table), "id") == [("x",), ("y",)]


def test_ranges_and_days_that_get_no_rows(spark, database):
    table = f"{database}.facts"
    tables.store_range(facts(spark, *((c, (1, d)) for d, c in enumerate("abcdef", 1))), table)
    days = tables.store_ranges(facts(spark, ("x", (1, 5))), table, [(date(2024, 1, 1), date(2024, 1, 2)), (date(2024, 1, 5), date(2024, 1, 5))])
    assert days == [date(2024, 1, d) for d in (1, 2, 5)]
    assert rows(spark.table(table), "id") == [("c",), ("d",), ("f",), ("x",)]
    tables.store_days(facts(spark, ("y", (1, 3))), table, [date(2024, 1, 6)])
    assert rows(spark.table(table), "id") == [("d",), ("x",), ("y",)]


def versions_run(spark, table, moment, *airports):
    now = spark.createDataFrame(list(airports), "id int, name string")
    schema = incremental.scd2_columns(now.schema)
    versions = tables.settled(incremental.scd2(tables.open_versions(spark, table, schema), now, "id", ["name"], moment))
    ended = F.col("dbt_valid_to").isNotNull()
    tables.store_versions(versions.where(ended), versions.where(~ended), table)


def test_versions_equal_the_operator_and_closed_ones_are_not_written_again(spark, database):
    table = f"{database}.versions"
    runs = [(1, (1, "a"), (2, "b")), (11, (1, "A"), (2, "b")), (11, (1, "A"), (2, "b")), (21, (1, "A"), (2, "B"), (3, "c")), (31, (1, "x"))]
    history, seen = None, []
    for day, *airports in runs:
        moment = datetime(2024, 1, day)
        now = spark.createDataFrame(airports, "id int, name string")
        history = empty_frame(spark, incremental.scd2_columns(now.schema)) if history is None else history
        rows_now = incremental.scd2(history, now, "id", ["name"], moment).collect()
        history = spark.createDataFrame(rows_now, history.schema)
        versions_run(spark, table, moment, *airports)
        assert rows(tables.read(spark, table)) == rows(history)
        files = set(spark.table(f"{table}__rows").inputFiles())
        assert set(seen) <= files  # files of closed versions stay
        seen = files
        assert rows(tables.open_versions(spark, table, history.schema)) == rows(history.where("dbt_valid_to IS NULL"))


@pytest.mark.parametrize("step", ["_append", "_list", "_write_whole", "_switch"])
def test_versions_of_a_stopped_run(spark, database, monkeypatch, step):
    table = f"{database}.versions"
    versions_run(spark, table, datetime(2024, 1, 1), (1, "a"), (2, "b"))
    old = rows(tables.read(spark, table))

    def stopping(*given):
        raise Stopped

    with monkeypatch.context() as patch:
        patch.setattr(tables, step, stopping)
        with pytest.raises(Stopped):
            versions_run(spark, table, datetime(2024, 1, 11), (1, "A"), (2, "b"))
    assert rows(tables.read(spark, table)) == old
    versions_run(spark, table, datetime(2024, 1, 11), (1, "A"), (2, "b"))
    assert rows(tables.read(spark, table), "name", "dbt_valid_to") == [("A", None), ("a", datetime(2024, 1, 11)), ("b", None)]
