"""Incremental strategies as functions from (target, batch) to the new target."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from contrail.operators.staging import stg_airports

# Fixed values.
AIRPORT_KEY = "id"
AIRPORT_CHECK_COLUMNS = [
    "icao_code",
    "type",
    "airport",
    "latitude",
    "longitude",
    "elevation",
    "municipality",
    "iso_country",
]


class SchemaDrift(ValueError):
    """A batch whose columns differ from those of its target."""


def assert_same_schema(batch: StructType, target: StructType) -> None:
    """Names and types must agree; order and nullability may differ."""

    def shape(schema):
        return {field.name.lower(): field.dataType for field in schema}

    if shape(batch) != shape(target):
        raise SchemaDrift(f"batch {batch.simpleString()} does not fit target {target.simpleString()}")


def batch_bounds(batch: DataFrame, column: str = "dof") -> DataFrame:
    """Smallest and largest day of the batch and the month of the smallest."""
    return batch.agg(
        F.min(column).alias("lo"),
        F.max(column).alias("hi"),
        F.trunc(F.min(column), "month").alias("month"),
    )


def replace_range(target: DataFrame, batch: DataFrame, column: str = "dof") -> DataFrame:
    """Target rows outside the batch's range of ``column``, plus the batch.

    Rows with a NULL in ``column`` stay; an empty batch changes nothing.
    """
    bounds = batch_bounds(batch, column)
    inside = F.col(column).between(bounds.select("lo").scalar(), bounds.select("hi").scalar())
    return target.where(~F.coalesce(inside, F.lit(False))).unionByName(batch)


def replace_month(
    target: DataFrame, batch: DataFrame, column: str = "dof", first_month_only: bool = False
) -> DataFrame:
    """Target rows outside the months of the batch, plus the batch.

    ``first_month_only`` clears just the month of the smallest day.
    """
    months = batch.select(F.trunc(column, "month").alias("month"))
    months = months.agg(F.min("month").alias("month")) if first_month_only else months.distinct()
    # A date has at most 12 * 9999 months, whatever the size of the batch.
    kept = target.join(F.broadcast(months), F.trunc(target[column], "month") == months["month"], "left_anti")
    return kept.unionByName(batch)


def _single(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """(keys, row struct) with one row per key; the job fails on a repeated key.

    Keys are counted by hash aggregation, which sums up many copies of a key before they meet in one task,
    and the counts are joined to the rows.
    """
    repeated = F.concat(F.lit(f"repeated key in {what}: "), F.to_json(F.struct(keys)))
    copies = df.groupBy(*keys).agg(F.count("*").alias("_copies"))
    rows = df.select(*keys, F.struct(df.columns).alias("row")).join(copies, keys)
    return rows.select(*keys, F.when(F.col("_copies") > 1, F.raise_error(repeated)).otherwise(F.col("row")).alias("row"))


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], updated: list[str]) -> DataFrame:
    """Update ``updated`` of the rows whose keys match, insert source rows that match none.

    NULL keys match nothing. A key that the source repeats fails the job.
    """
    assert_same_schema(source.schema, target.schema)
    names = target.columns
    matchable = F.lit(True)
    for key in keys:
        matchable = matchable & F.col(key).isNotNull()
    incoming = _single(source.where(matchable), keys, "merge source").withColumnRenamed("row", "new")
    current = target.select(*keys, F.struct(names).alias("old"))
    joined = current.join(incoming, keys, "full_outer")

    def value(name):
        old, new = F.col(f"old.{name}"), F.col(f"new.{name}")
        if name in updated:
            return F.when(F.col("new").isNotNull(), new).otherwise(old).alias(name)
        return F.when(F.col("old").isNotNull(), old).otherwise(new).alias(name)

    return joined.select(*map(value, names)).unionByName(source.where(~matchable))


def scd2_columns(schema: StructType) -> StructType:
    """A snapshot's schema: the source columns and the four validity columns."""
    validity = StructType().add("dbt_scd_id", "string")
    for name in ("dbt_updated_at", "dbt_valid_from", "dbt_valid_to"):
        validity = validity.add(name, "timestamp_ntz")
    return StructType(schema.fields + validity.fields)


def scd2(
    history: DataFrame,
    current: DataFrame,
    key: str,
    check_columns: list[str],
    now: datetime,
    close_missing: bool = False,
) -> DataFrame:
    """Versions after comparing the open ones with ``current`` on ``check_columns``.

    A changed row closes its open version and opens one; an unchanged row and, unless
    ``close_missing``, a row absent from ``current`` leave theirs as it is. A repeated key in
    ``current`` fails the job.
    """
    names = history.columns
    moment = F.lit(now).cast("timestamp_ntz")
    never = F.lit(None).cast("timestamp_ntz")
    is_open = F.col("dbt_valid_to").isNull()
    latest = history.where(is_open).select(key, F.struct(names).alias("old"))
    incoming = _single(current, [key], "snapshot source").withColumnRenamed("row", "new")
    joined = latest.join(incoming, key, "full_outer")

    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    same = F.lit(True)
    for name in check_columns:
        same = same & F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    ended = has_old & ((has_new & ~same) | (~has_new & F.lit(close_missing)))

    validity = {
        "dbt_scd_id": F.md5(F.concat_ws("|", F.col(key).cast("string"), moment.cast("string"))),
        "dbt_updated_at": moment,
        "dbt_valid_from": moment,
        "dbt_valid_to": never,
    }

    def kept(name) -> Column:
        old = F.col(f"old.{name}")
        return (F.when(ended, moment).otherwise(old) if name == "dbt_valid_to" else old).alias(name)

    def opened(name) -> Column:
        return (validity[name] if name in validity else F.col(f"new.{name}")).alias(name)

    versions = F.array(
        F.when(has_old, F.struct(*map(kept, names))),
        F.when(has_new & (~has_old | ~same), F.struct(*map(opened, names))),
    )
    touched = (
        joined.select(F.explode(versions).alias("version")).where(F.col("version").isNotNull()).select("version.*")
    )
    return history.where(~is_open).unionByName(touched)


def snapshot_airports(
    history: DataFrame, raw_airports: DataFrame, now: datetime, close_missing: bool = False
) -> DataFrame:
    return scd2(history, stg_airports(raw_airports), AIRPORT_KEY, AIRPORT_CHECK_COLUMNS, now, close_missing)
