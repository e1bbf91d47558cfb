"""Stored marts: tables of the session catalog whose readers see all of a write or nothing of it.

Built-in Parquet tables know no transaction, so a mart ``t`` is a view, and a write prepares everything beside
it and then alters the view, which is one change of the catalog:

1. the rows are appended to ``t__rows``, partitioned by a value (a day, say) and by the write that brought them;
2. ``t__parts_<write>`` lists the valid (value, write) pairs: those of the writes before, without what this one
   replaces, and its own;
3. the view is altered to read the pairs of that list.

Whatever a run left that stopped before the third step is not seen by anyone. The next write drops it, together
with partitions that no list names any more; partitions of the state that readers may still be reading stay until
then. Only partitions with new rows are written. One writer at a time.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from contrail.operators.accumulate import STATE_SCHEMA, accumulate
from contrail.operators.incremental import assert_same_schema, merge_upsert
from contrail.session import empty_frame, ensure_checkpoints

Replaced = Callable[[date], bool]


def _rows(table: str) -> str:
    return f"{table}__rows"


def _parts(table: str, write: str) -> str:
    return f"{table}__parts_{write}"


def _whole(table: str, write: str) -> str:
    return f"{table}__whole_{write}"


def _current_write(spark: SparkSession, table: str) -> str | None:
    """The write whose state readers of the table see."""
    if not spark.catalog.tableExists(table):
        return None
    found = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r["col_name"] == "View Text"]
    return re.search(r"__(?:parts|whole)_([0-9a-f]{32})", found[0])[1]


def _beside(spark: SparkSession, table: str, kind: str) -> list[str]:
    """The tables of a kind that the mart's writes have left."""
    database, _, name = table.rpartition(".")
    within = f" IN {database}" if database else ""
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES{within} LIKE '{name.lower()}__{kind}*'").collect()]
    return [f"{database}.{t}" if database else t for t in found if re.fullmatch(rf"{name.lower()}__{kind}_[0-9a-f]{{32}}", t)]


def _switch(spark: SparkSession, table: str, query: str) -> None:
    """Show readers a new state of the table: one statement that changes one catalog entry."""
    spark.sql(f"{'ALTER' if spark.catalog.tableExists(table) else 'CREATE'} VIEW {table} AS {query}")


def read(spark: SparkSession, table: str) -> DataFrame:
    """The stored table as it is now, also where another session (a stream's, say) has written it."""
    if spark.catalog.tableExists(_rows(table)):
        spark.catalog.refreshTable(_rows(table))
    spark.catalog.refreshTable(table)
    return spark.table(table)


def read_or_empty(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """The stored table or, before the first run, an empty frame of its schema."""
    return read(spark, table) if spark.catalog.tableExists(table) else empty_frame(spark, schema)


def _value(partition: str) -> date:
    if "__HIVE_DEFAULT_PARTITION__" in partition:
        raise ValueError(f"rows without a {partition.split('=', 1)[0]} cannot be stored")
    return date.fromisoformat(partition.split("=", 1)[1])


def _stored_pairs(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    """(value, write) of all partitions, valid or not, from the catalog."""
    if not spark.catalog.tableExists(_rows(table)):
        return []
    found = (r[0].rsplit("/", 1) for r in spark.sql(f"SHOW PARTITIONS {_rows(table)}").collect())
    return [(value, write.split("=", 1)[1]) for value, write in found]


def _valid_pairs(spark: SparkSession, table: str) -> list[tuple[date, str]]:
    """(value, write) of the partitions that readers see: at most one for each day of the calendar."""
    write = _current_write(spark, table)
    return [tuple(r) for r in spark.table(_parts(table, write)).collect()] if write else []


def _clean(spark: SparkSession, table: str, column: str) -> None:
    """Drop what belongs neither to the current state nor to a write under way."""
    write, valid = _current_write(spark, table), set(_valid_pairs(spark, table))
    stale = []
    for value, of in _stored_pairs(spark, table):
        known = "__HIVE_DEFAULT_PARTITION__" not in value
        if not known or (_value(value), of) not in valid:
            stale.append(f"PARTITION ({column} = {f"DATE '{_value(value)}'" if known else 'NULL'}, written = '{of}')")
    if stale:
        spark.sql(f"ALTER TABLE {_rows(table)} DROP IF EXISTS {', '.join(stale)}")
    for old in _beside(spark, table, "parts"):
        if write is None or not old.endswith(write):
            spark.sql(f"DROP TABLE IF EXISTS {old}")


def _append(batch: DataFrame, table: str, column: str, write: str) -> list[date]:
    """Store the rows where no reader looks yet; the values they have.

    Rebalancing by the partition column gives files of the advisory size: one task per day, several for
    a large day, and not one small file per task and day.
    """
    spark, rows = batch.sparkSession, _rows(table)
    batch = batch.withColumn("written", F.lit(write)).hint("rebalance", column)
    if spark.catalog.tableExists(rows):
        target = spark.table(rows)
        assert_same_schema(batch.schema, target.schema)
        batch.select(target.columns).write.insertInto(rows)
    else:
        batch.write.format("parquet").partitionBy(column, "written").saveAsTable(rows)
    return [_value(value) for value, of in _stored_pairs(spark, table) if of == write]


def _list(spark: SparkSession, table: str, column: str, write: str, pairs: Iterable[tuple[date, str]]) -> None:
    listed = spark.createDataFrame(sorted(pairs), f"{column} date, written string").coalesce(1)
    listed.write.format("parquet").saveAsTable(_parts(table, write))


def _commit(batch: DataFrame, table: str, column: str, replaced: Callable[[list[date]], Replaced]) -> list[date]:
    """Store ``batch`` in place of the stored values that ``replaced``, given the batch's, is true for.

    Gives the values that were stored or replaced, sorted. A batch without rows changes nothing.
    """
    spark, write = batch.sparkSession, uuid.uuid4().hex
    _clean(spark, table, column)
    values = _append(batch, table, column, write)
    if not values:
        return []
    goes, valid = replaced(values), _valid_pairs(spark, table)
    kept = [(value, of) for value, of in valid if value not in values and not goes(value)]
    _list(spark, table, column, write, kept + [(value, write) for value in values])
    names = ", ".join(f"r.`{c}`" for c in spark.table(_rows(table)).columns if c != "written")
    # The list has a row for each day of the calendar at most.
    _switch(
        spark, table,
        f"SELECT /*+ BROADCAST(p) */ {names} FROM {_rows(table)} r LEFT SEMI JOIN {_parts(table, write)} p"
        f" ON r.{column} = p.{column} AND r.written = p.written",
    )
    return sorted({*values, *(value for value, _ in valid if goes(value))})


def _ends(values: list[date]) -> Replaced:
    return lambda value: values[0] <= value <= values[-1]


def store_range(batch: DataFrame, table: str, column: str = "dof") -> list[date]:
    """Replace the stored rows from the batch's first to its last day by the batch; the days that may have changed."""
    return _commit(batch, table, column, lambda values: _ends(sorted(values)))


def store_ranges(batch: DataFrame, table: str, ranges: list[tuple[date, date]], column: str = "dof") -> list[date]:
    """The same for several ranges at once, which the batch lies in."""
    return _commit(batch, table, column, lambda _: lambda value: any(lo <= value <= hi for lo, hi in ranges))


def store_days(batch: DataFrame, table: str, days: list[date], column: str = "dof") -> list[date]:
    """Replace the stored rows of exactly these days, and of those the batch has, by the batch."""
    return _commit(batch, table, column, lambda _: set(days).__contains__)


def store_months(batch: DataFrame, table: str, column: str = "dof") -> list[date]:
    """Replace the stored rows of every month the batch has rows in by the batch."""

    def replaced(values: list[date]) -> Replaced:
        months = {(d.year, d.month) for d in values}
        return lambda value: (value.year, value.month) in months

    return _commit(batch, table, column, replaced)


def settled(df: DataFrame) -> DataFrame:
    """The rows on the shared checkpoint folder, for plans that are used several times."""
    ensure_checkpoints(df.sparkSession)
    return df.checkpoint()


def store_merge(batch: DataFrame, table: str, keys: list[str], updated: list[str], partition: str) -> None:
    """Merge the batch into the table; only the partitions that the batch touches are read and written.

    ``partition`` must be one of the keys, so that no row can change its partition.
    """
    if partition not in keys:
        raise ValueError(f"{partition} is not a merge key")
    target = read_or_empty(batch.sparkSession, table, batch.schema)
    # One row per day of the calendar at most.
    touched = F.broadcast(batch.select(partition).distinct())
    merged = merge_upsert(target.join(touched, partition, "left_semi").select(target.columns), batch, keys, updated)
    _commit(merged, table, partition, lambda _: lambda value: False)


def store_period(current: DataFrame, table: str, year: date, slot: int | None = None) -> None:
    """Advance the metric arrays of the year by one period of (hex, count)."""
    state = read_or_empty(current.sparkSession, table, STATE_SCHEMA)
    store_days(accumulate(state, current, year, slot), table, [], "year_start")


def _write_whole(df: DataFrame, table: str, write: str) -> None:
    """Store rows where no reader looks yet, and drop such tables of writes before the current one."""
    spark = df.sparkSession
    current = _current_write(spark, table)
    if current:
        assert_same_schema(df.schema, spark.table(table).schema)
    for old in _beside(spark, table, "whole"):
        if current is None or not old.endswith(current):
            spark.sql(f"DROP TABLE IF EXISTS {old}")
    df.hint("rebalance").write.format("parquet").saveAsTable(_whole(table, write))


def replace(df: DataFrame, table: str) -> None:
    """Replace a whole table by rows that may be computed from it, such as a dimension's next state."""
    spark, write = df.sparkSession, uuid.uuid4().hex
    _write_whole(df, table, write)
    _switch(spark, table, f"SELECT * FROM {_whole(table, write)}")


CLOSED_ON = "closed_on"


def store_versions(closed: DataFrame, current: DataFrame, table: str, ended: str = "dbt_valid_to") -> None:
    """Append versions that have ended, by the day of their end, and replace the ones that have not.

    A run over ``open_versions`` so reads and writes no version that ended before; readers see all of them.
    """
    spark, write = current.sparkSession, uuid.uuid4().hex
    _clean(spark, table, CLOSED_ON)
    values = _append(closed.withColumn(CLOSED_ON, F.to_date(ended)), table, CLOSED_ON, write)
    _list(spark, table, CLOSED_ON, write, _valid_pairs(spark, table) + [(value, write) for value in values])
    _write_whole(current, table, write)
    names = ", ".join(f"`{c}`" for c in current.columns)
    # The list has a row for each day on which a run closed versions.
    _switch(
        spark, table,
        f"SELECT {names} FROM {_whole(table, write)} UNION ALL SELECT /*+ BROADCAST(p) */ {names} FROM {_rows(table)} r"
        f" LEFT SEMI JOIN {_parts(table, write)} p ON r.{CLOSED_ON} = p.{CLOSED_ON} AND r.written = p.written",
    )


def open_versions(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """What ``store_versions`` stored last as not ended, or an empty frame of the schema before the first run."""
    write = _current_write(spark, table)
    return spark.table(_whole(table, write)) if write else empty_frame(spark, schema)
