"""Loading raw files by column name, and the naming of the files per month or 10-day period."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from contrail.functions.times import PERIOD_DAYS


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Pick the declared columns by case-insensitive name and cast them.

    A declared column that the files lack is NULL, an undeclared one is left out. Values that do not
    fit the declared type fail the load (ANSI casts).
    """
    found = {name.lower(): name for name in df.columns}

    def column(field):
        name = found.get(field.name.lower())
        value = F.lit(None) if name is None else F.col(f"`{name}`")
        return value.cast(field.dataType).alias(field.name)

    return df.select([column(field) for field in schema])


def _united(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def load_parquet(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Read files whose columns may differ in set, order and case, each by its own names.

    Paths with the same columns are read together; inside a folder the files' schemas are merged.
    """
    merging = spark.read.option("mergeSchema", True)
    alike: dict[str, list[str]] = {}
    for one in [path] if isinstance(path, str) else path:
        alike.setdefault(merging.parquet(one).schema.json(), []).append(one)
    return _united([conform(merging.parquet(*paths), schema) for paths in alike.values()])


def load_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    *,
    separator: str = ",",
    quote: str = '"',
    escape: str = '"',
    null_text: str = "",
) -> DataFrame:
    """Read CSV files with a header; columns are matched by header name, not by position.

    Every path has a header of its own. Files below one folder must have the same header, else the load fails.
    """
    # Only the header line is needed for the names, so one line is read, not the file.
    reader = spark.read.options(
        header=True,
        sep=separator,
        quote=quote,
        escape=escape,
        nullValue=null_text,
        multiLine=False,
        mode="FAILFAST",
        enforceSchema=False,
    )
    return _united([conform(reader.csv(one), schema) for one in ([path] if isinstance(path, str) else path)])


def month_file(root: str, month: date, kind: str = "flight_list") -> str:
    return f"{root.rstrip('/')}/{kind}_{month:%Y%m}.parquet"


def period_file(root: str, start: date, end: date, kind: str = "flight_events") -> str:
    """File of the period that begins on ``start`` and ends before ``end``."""
    return f"{root.rstrip('/')}/{kind}_{start:%Y%m%d}_{end:%Y%m%d}.parquet"


def periods(first: date, last: date, days: int = PERIOD_DAYS) -> Iterator[tuple[date, date]]:
    """Consecutive (start, end) pairs; the last one starts no later than ``last``."""
    start = first
    while start <= last:
        yield start, start + timedelta(days=days)
        start += timedelta(days=days)


def with_file_period(df: DataFrame) -> DataFrame:
    """Add ``file_start`` and ``file_end`` read from the name of the file each row came from.

    A month file gives the first day of its month and of the next one.
    """
    name = F.col("_metadata.file_name")
    # The two file name formats.
    day, until = (F.regexp_extract(name, r"_(\d{8})_(\d{8})\.parquet$", i) for i in (1, 2))
    month = F.regexp_extract(name, r"_(\d{6})\.parquet$", 1)
    month_day = F.try_to_date(F.concat(month, F.lit("01")), "yyyyMMdd")
    return df.select(
        "*",
        F.coalesce(F.try_to_date(day, "yyyyMMdd"), month_day).alias("file_start"),
        F.coalesce(F.try_to_date(until, "yyyyMMdd"), F.add_months(month_day, 1)).alias("file_end"),
    )


def replace_raw_table(df: DataFrame, name: str) -> DataFrame:
    """Land a raw table anew, dropping what an earlier run left there."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)
