"""Load gates and declared tests, as reports or as frames of failing rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StructType


class QualityError(AssertionError):
    """A gate or an enforced test failed."""


def load_gate(df: DataFrame, required: list[str]) -> DataFrame:
    """One row of booleans: each required column without NULLs, and at least one row. One pass."""
    checks = [
        (F.count_if(F.col(column).isNull()) == 0).alias(f"{column}_is_not_null_check") for column in required
    ]
    return df.agg(*checks, (F.count("*") > 0).alias("is_there_data_check"))


def enforce_gate(df: DataFrame, required: list[str]) -> None:
    """Raise with the names of the failed checks."""
    report = load_gate(df, required).first()
    if report is None:
        raise QualityError("the gate returned no result")
    failed = [name for name, passed in report.asDict().items() if passed is not True]
    if failed:
        raise QualityError(f"load gate failed: {', '.join(failed)}")


def not_null(column: str) -> Column:
    """The row fails: the column is NULL."""
    return F.col(column).isNull()


def accepted_values(column: str, values: list) -> Column:
    """The row fails: the value is not in the list. NULL passes."""
    return F.coalesce(~F.col(column).isin(values), F.lit(False))


def between(
    column: str,
    low: float | None = None,
    high: float | None = None,
    strictly: bool = False,
    where: Column | None = None,
) -> Column:
    """The row fails: out of range, among the rows ``where`` holds for.

    Either end may be open. NULL passes, as its comparison is neither true nor false.
    """
    value = F.col(column)
    inside = F.lit(True)
    if low is not None:
        inside = inside & ((value > low) if strictly else (value >= low))
    if high is not None:
        inside = inside & ((value < high) if strictly else (value <= high))
    considered = F.lit(True) if where is None else where
    return F.coalesce(considered & ~inside, F.lit(False))


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Values that occur more than once, with their number; rows with any NULL are skipped."""
    counted = df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("rows"))
    return counted.where(F.col("rows") > 1)


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-NULL reference has no parent."""
    known = parent.select(F.col(field).alias("parent_key"))
    return child.dropna(subset=[column]).join(known, child[column] == known["parent_key"], "left_anti")


def of_type(schema: StructType, column: str, *types: DataType) -> bool:
    """Whether the column has one of the types. Reads the schema, runs no job."""
    return schema[column].dataType in types


@dataclass(frozen=True)
class Check:
    """A declared test: a name, the column(s) it is about, and how rows fail it."""

    name: str
    columns: tuple[str, ...]
    row_fails: Column | None = None
    types: tuple[DataType, ...] = ()
    parent: tuple[DataFrame, str] | None = None

    @property
    def label(self) -> str:
        return f"{self.name}({', '.join(self.columns)})"


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Failures per check: (test, failures).

    All row-level checks share one aggregation pass; only uniqueness and references need a grouping or
    join of their own. Type checks come from the schema.
    """
    by_row = [c for c in checks if c.row_fails is not None or c.types]
    parts = []
    if by_row:

        def failures(check):
            if check.types:
                return F.max(F.lit(_type_failures(df.schema, check)).cast("bigint"))
            return F.count_if(check.row_fails)

        counted = df.agg(*(F.coalesce(failures(c), F.lit(0)).alias(f"c{i}") for i, c in enumerate(by_row)))
        entries = [F.struct(F.lit(c.label).alias("test"), F.col(f"c{i}").alias("failures")) for i, c in enumerate(by_row)]
        parts.append(counted.select(F.inline(F.array(*entries))))
    for check in checks:
        if check.parent is not None:
            failing = relationships(df, check.columns[0], *check.parent)
        elif check.name == "unique":
            failing = unique(df, *check.columns)
        else:
            continue
        parts.append(failing.agg(F.count("*").alias("failures")).select(F.lit(check.label).alias("test"), "failures"))
    return reduce(DataFrame.unionByName, parts)


def _type_failures(schema: StructType, check: Check) -> int:
    return 0 if of_type(schema, check.columns[0], *check.types) else 1


def day_failures(df: DataFrame, checks: list[Check], day: str = "dof") -> DataFrame:
    """(day, test, failures) of the checks that look at single rows: a state that adds up over days.

    A day without rows has no entry; checks of types, uniqueness and references are left to ``added_up`` and
    ``run_checks``.
    """
    by_row = [c for c in checks if c.row_fails is not None]
    counted = df.groupBy(day).agg(*(F.count_if(c.row_fails).alias(f"c{i}") for i, c in enumerate(by_row)))
    entries = [F.struct(F.lit(c.label).alias("test"), F.col(f"c{i}").alias("failures")) for i, c in enumerate(by_row)]
    return counted.select(F.inline(F.array(*entries)), day)


def added_up(failures: DataFrame, checks: list[Check], schema: StructType) -> DataFrame:
    """(test, failures) over all days of ``day_failures``, as ``run_checks`` counts them for a table of this schema.

    Only for checks of rows and types, which need no look at the table.
    """
    whole = [c.label for c in checks if c.row_fails is None and not c.types]
    if whole:
        raise ValueError(f"checks that don't add up over days: {', '.join(whole)}")
    spark = failures.sparkSession
    listed = [(c.label, _type_failures(schema, c) if c.types else 0) for c in checks]
    known = spark.createDataFrame(listed, "test string, failures bigint")  # a row for each declared check
    both = known.unionByName(failures.select("test", "failures"))
    return both.groupBy("test").agg(F.sum("failures").alias("failures"))


def enforce_checks(df: DataFrame, checks: list[Check]) -> None:
    failed = run_checks(df, checks).where(F.col("failures") > 0).collect()
    if failed:
        raise QualityError("; ".join(f"{row.test}: {row.failures}" for row in failed))


def profile(df: DataFrame, key: list[str], exact: bool = True) -> DataFrame:
    """Per column: missing values, distinct values, smallest and largest; and repeated keys.

    Counts and extremes come from one pass. Exact distinct counts group (column, value) pairs, which
    aggregates before the shuffle; ``exact=False`` takes sketches in the first pass instead, about 5 %
    off, for the widest tables.
    """
    names = df.columns
    values = [F.col(f"`{name}`") for name in names]
    measures = []
    for i, value in enumerate(values):
        measures += [
            F.count_if(value.isNull()).alias(f"missing_{i}"),
            F.min(value).cast("string").alias(f"low_{i}"),
            F.max(value).cast("string").alias(f"high_{i}"),
        ]
        if not exact:
            measures.append(F.approx_count_distinct(value).alias(f"distinct_{i}"))
    whole = df.agg(F.count("*").alias("rows"), *measures)
    entries = [
        F.struct(
            F.lit(name).alias("column"),
            F.col("rows"),
            F.col(f"missing_{i}").alias("missing"),
            *([] if exact else [F.col(f"distinct_{i}").alias("distinct_values")]),
            F.col(f"low_{i}").alias("low"),
            F.col(f"high_{i}").alias("high"),
        )
        for i, name in enumerate(names)
    ]
    report = whole.select(F.inline(F.array(*entries)))
    if exact:
        pairs = F.array(*(F.struct(F.lit(i).alias("i"), v.cast("string").alias("v")) for i, v in enumerate(values)))
        distinct = df.select(F.inline(pairs)).where(F.col("v").isNotNull()).distinct().groupBy("i").count()
        named = F.element_at(F.array(*map(F.lit, names)), F.col("i") + 1).alias("column")
        # One row per column of the table.
        counts = F.broadcast(distinct.select(named, F.col("count").alias("distinct_values")))
        report = report.join(counts, "column", "left").fillna(0, "distinct_values")
    repeated = df.groupBy(*key).count().agg(F.sum(F.col("count") - 1)).scalar()
    report = report.withColumn("repeated_keys", F.coalesce(repeated, F.lit(0).cast("bigint")))
    return report.select("column", "rows", "missing", "distinct_values", "low", "high", "repeated_keys")
