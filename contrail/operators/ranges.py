"""Equal-range breaks of a column and the bucket of each value between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fractions of the value range at which the map colours change.
OVERVIEW_FRACTIONS = [0.001, 0.03, 0.08, 0.2, 0.35, 0.45, 1]
AIRPORT_FRACTIONS = [0.01, 0.05, 0.1, 0.25, 0.4, 0.5, 1]
ALTITUDE_FRACTIONS = [0.01, 0.05, 0.15, 0.3, 0.5, 0.7, 1]


def _cut(low: Column, high: Column, fraction: float) -> Column:
    return (low + (high - low) * F.lit(float(fraction))).cast("bigint")


def range_breaks(df: DataFrame, column: str, fractions: list[float]) -> DataFrame:
    """(position, value): the point at each fraction of the way from minimum to maximum, cut to an int.

    These are shares of the range, not quantiles of the rows.
    """
    ends = df.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    cuts = F.array(*(_cut(F.col("low"), F.col("high"), f) for f in fractions))
    return ends.select(F.posexplode(cuts).alias("position", "value"))


def range_bucket(value: Column, ends: Column, fractions: list[float]) -> Column:
    """How many breaks between ``ends`` (struct low, high) the value has reached."""
    return sum(
        (F.when(value >= _cut(ends["low"], ends["high"], f), 1).otherwise(0) for f in fractions),
        F.lit(0),
    )


def with_range_bucket(df: DataFrame, column: str, fractions: list[float], name: str = "bucket") -> DataFrame:
    """Add the bucket of each value between the column's extremes.

    The two extremes enter as one scalar subquery, so no row is joined or shuffled.
    """
    ends = df.agg(F.struct(F.min(column).alias("low"), F.max(column).alias("high")).alias("ends")).scalar()
    return df.withColumn("_ends", ends).withColumn(name, range_bucket(F.col(column), F.col("_ends"), fractions)).drop("_ends")
