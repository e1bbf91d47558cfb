"""Helpers for array-valued metrics (one slot per period)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def zeros(n: Column) -> Column:
    """``n`` zeros; none for NULL or a negative ``n``."""
    return F.array_repeat(F.lit(0).cast("bigint"), F.greatest(F.coalesce(n, F.lit(0)), F.lit(0)).cast("int"))


def padded(values: Column, length: Column) -> Column:
    """``values`` (an empty array for NULL) followed by zeros up to ``length``."""
    present = F.coalesce(values, F.array().cast("array<bigint>"))
    return F.concat(present, zeros(length - F.size(present)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    Array lambdas are interpreted: what they repeat is computed as often as it is written.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def total(values: Column) -> Column:
    return F.reduce(values, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def unquoted(text: Column) -> Column:
    """Without the double quotes that an id flattened from JSON carries."""
    return F.replace(text, F.lit('"'))
