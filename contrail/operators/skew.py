"""Keys that hold too many rows for one task, and a join that spreads them.

Adaptive execution splits a skewed join only where both sides come straight from a shuffle and nothing
above relies on the join's partitioning. The joins on flights and aircraft do not all fulfil that, so
their hot keys are spread here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, *columns: str, rows: int = HOT_ROWS) -> DataFrame:
    """(columns, pieces) of all keys with more than ``rows`` rows, NULL among them.

    ``pieces`` is how many pieces of ``rows`` rows a key makes. The frame only steers the physical work,
    results never depend on it.
    """
    counts = df.groupBy(*columns).agg(F.count("*").alias("rows"))
    return counts.where(F.col("rows") > rows).select(*columns, F.ceil(F.col("rows") / rows).alias("pieces"))


def _all(conditions) -> Column:
    return reduce(Column.__and__, conditions)


def with_pieces(df: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """Add ``_pieces``: the number of pieces of a hot key, NULL for an ordinary one.

    ``hot`` may be about the first of the keys only. Its size follows the data, so Spark chooses the join.
    """
    names = [f"_hot_{i}" for i in range(len(hot.columns) - 1)]
    marks = hot.toDF(*names, "_pieces")
    return df.join(marks, _all(F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)), "left")


def split_join(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    hot: DataFrame,
    spread_by: list[str],
    how: str = "inner",
) -> DataFrame:
    """Join ``left`` with ``right`` on equal columns, ``on`` maps left to right names; inner or left.

    Rows of ``left`` with a hot key, NULL included, go to one of the key's pieces by a hash of
    ``spread_by``; the rows of ``right`` with that key are repeated for each piece. The result has the
    columns of both sides but the right keys.
    """
    keys, kept = list(on), left.columns
    others = [c for c in right.columns if c not in on.values()]
    right_keys = [f"_right_{i}" for i in range(len(on))]
    spread = F.xxhash64(*spread_by)
    piece = F.when(F.col("_pieces").isNotNull(), F.pmod(spread, F.col("_pieces"))).otherwise(F.lit(0).cast("bigint"))
    placed = with_pieces(left, keys, hot).select(*kept, piece.alias("_piece"))
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_pieces", F.lit(1)) - 1))
    named = right.dropna(subset=list(on.values())).select(*others, *(F.col(r).alias(n) for r, n in zip(on.values(), right_keys)))
    repeated = with_pieces(named, right_keys, hot).select(*others, *right_keys, copies.alias("_copy"))
    same_key = _all(F.col(k) == F.col(r) for k, r in zip(keys, right_keys))
    return placed.join(repeated, same_key & (F.col("_piece") == F.col("_copy")), how).select(*kept, *others)
