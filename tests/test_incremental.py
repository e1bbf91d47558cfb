from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from contrail.operators import incremental
from contrail.session import empty_frame


def days(spark, *entries):
    """(id, day of January or None)."""
    return spark.createDataFrame([(i, d and date(2024, 1, d)) for i, d in entries], "id string, dof date")


def test_range_is_replaced_with_its_gaps(spark):
    stored = days(spark, ("a", 1), ("b", 2), ("c", 3), ("d", 4), ("n", None))
    batch = days(spark, ("x", 2), ("y", 4))
    once = incremental.replace_range(stored, batch)
    assert rows(once, "id") == [("a",), ("n",), ("x",), ("y",)]
    assert rows(incremental.replace_range(once, batch)) == rows(once)


def test_empty_batch_changes_nothing(spark):
    stored = days(spark, ("a", 1), ("n", None))
    nothing = empty_frame(spark, stored.schema)
    assert rows(incremental.replace_range(stored, nothing)) == rows(stored)
    assert rows(incremental.replace_month(stored, nothing)) == rows(stored)


def test_every_month_of_the_batch_is_replaced(spark):
    def months(*entries):
        return spark.createDataFrame([(i, date(2024, m, d)) for i, m, d in entries], "id string, dof date")

    stored = months(("a", 1, 5), ("b", 2, 5), ("c", 3, 5))
    batch = months(("x", 1, 9), ("y", 2, 9))
    assert rows(incremental.replace_month(stored, batch), "id") == [("c",), ("x",), ("y",)]
    coded = incremental.replace_month(stored, batch, first_month_only=True)
    assert rows(coded, "id") == [("b",), ("c",), ("x",), ("y",)]


def keyed(spark, *entries):
    return spark.createDataFrame(list(entries), "k string, v int, w int")


def test_merge_updates_inserts_and_keeps(spark):
    stored = keyed(spark, ("a", 1, 1), ("b", 2, 2), (None, 3, 3))
    batch = keyed(spark, ("b", 20, 20), ("c", 30, 30), (None, 40, 40))
    merged = incremental.merge_upsert(stored, batch, ["k"], ["v"])
    assert rows(merged) == sorted(
        [("a", 1, 1), ("b", 20, 2), (None, 3, 3), ("c", 30, 30), (None, 40, 40)], key=repr
    )


def test_merge_can_update_to_null(spark):
    merged = incremental.merge_upsert(keyed(spark, ("a", 1, 1)), keyed(spark, ("a", None, 5)), ["k"], ["v"])
    assert rows(merged) == [("a", None, 1)]


def test_repeated_source_key_fails(spark):
    batch = keyed(spark, ("a", 1, 1), ("a", 2, 2))
    with pytest.raises(PySparkException, match="repeated key"):
        incremental.merge_upsert(keyed(spark, ("z", 0, 0)), batch, ["k"], ["v"]).collect()


def test_schema_drift_fails(spark):
    with pytest.raises(incremental.SchemaDrift):
        incremental.merge_upsert(keyed(spark, ("a", 1, 1)), days(spark, ("a", 1)), ["k"], ["v"])
    incremental.assert_same_schema(keyed(spark).select("w", "v", "k").schema, keyed(spark).schema)


T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 11), datetime(2024, 1, 21)


def source(spark, *entries):
    return spark.createDataFrame(list(entries), "id int, name string, extra string")


def snapshot(spark, history, *entries, now, close_missing=False):
    current = source(spark, *entries)
    if history is None:
        history = empty_frame(spark, incremental.scd2_columns(current.schema))
    df = incremental.scd2(history, current, "id", ["name"], now, close_missing)
    return spark.createDataFrame(df.collect(), df.schema)


def versions(df):
    return rows(df, "id", "name", "extra", "dbt_valid_from", "dbt_valid_to")


def test_versions_open_close_and_stay(spark):
    first = snapshot(spark, None, (1, "a", "x"), (2, None, "x"), (3, "c", "x"), now=T0)
    assert versions(first) == [(1, "a", "x", T0, None), (2, None, "x", T0, None), (3, "c", "x", T0, None)]
    # 1 unchanged though its unchecked column is not; 2 gets a value; 3 is missing; 4 is new.
    second = snapshot(spark, first, (1, "a", "y"), (2, "b", "x"), (4, "d", "x"), now=T1)
    assert versions(second) == [
        (1, "a", "x", T0, None),
        (2, "b", "x", T1, None),
        (2, None, "x", T0, T1),
        (3, "c", "x", T0, None),
        (4, "d", "x", T1, None),
    ]
    assert versions(snapshot(spark, second, (1, "a", "y"), (2, "b", "x"), (4, "d", "x"), now=T2)) == versions(second)
    assert second.select("dbt_scd_id").distinct().count() == 5


def test_missing_rows_close_on_request_and_may_return(spark):
    first = snapshot(spark, None, (1, "a", "x"), (2, "b", "x"), now=T0)
    second = snapshot(spark, first, (1, "a", "x"), now=T1, close_missing=True)
    assert versions(second) == [(1, "a", "x", T0, None), (2, "b", "x", T0, T1)]
    third = snapshot(spark, second, (1, "a", "x"), (2, "b", "x"), now=T2)
    assert versions(third) == [(1, "a", "x", T0, None), (2, "b", "x", T0, T1), (2, "b", "x", T2, None)]
    still_open = third.where(F.col("dbt_valid_to").isNull()).groupBy("id").count()
    assert still_open.where("count > 1").count() == 0


def test_repeated_snapshot_key_fails(spark):
    with pytest.raises(PySparkException, match="repeated key"):
        snapshot(spark, None, (1, "a", "x"), (1, "b", "x"), now=T0)
