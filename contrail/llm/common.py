"""Helpers that several operators share: stored intermediate tables, checked broadcasts, components, ranks."""

from __future__ import annotations

import ctypes
import gc
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from contrail.session import shared_folder

BROADCAST_ROWS = 50_000  # a side is broadcast only after its rows were counted and are no more than this
SMALL_EDGES = 10_000  # so many pairs of numbers are no work for more than one task

BATCH_ROWS = 1_000  # texts that Spark and a Python worker hold at once, unless the session says otherwise

WORD = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application.

    Spark serves the archive from the driver, so its folder need not be shared.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    with_name = Path(tempfile.mkdtemp(prefix="ship-")) / package.name
    archive = shutil.make_archive(str(with_name), "zip", package.parent, package.name)
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches have ``BATCH_ROWS`` rows where the session has Spark's default of 10,000.

    An executor holds several copies of a batch for each task, outside its heap.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


Batches = Iterator[pa.RecordBatch]


def lean(function: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``function``, for ``mapInArrow``, after which a Python worker returns to the system what it holds no longer.

    Spark keeps the workers for later tasks, also beside stages that run in the JVM alone.
    """

    def run(batches: Batches) -> Batches:
        yield from function(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
        if trim is not None:
            trim(0)

    return run


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROW_KEY = ["_id", "_no_id", "_text"]


def keyed(docs: DataFrame, keep: list[str] | None = None, *more: Column) -> DataFrame:
    """(row, ``ROW_KEY``, more): ``keep``, else all, of each row as a struct, so that no names can clash.

    The key is equal, and never null, for rows that are equal in id and text.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in keep or docs.columns)).alias("row")
    return docs.select(row, *row_key(F.col("`doc_id`"), F.xxhash64("`text`")), *more)


def row_key(doc_id: Column, text_hash: Column) -> list[Column]:
    values = F.coalesce(doc_id.cast("long"), F.lit(0)), doc_id.isNull(), text_hash
    return [value.alias(name) for name, value in zip(ROW_KEY, values)]


def unkeyed(rows: DataFrame, like: DataFrame) -> DataFrame:
    """The rows of a keyed frame, with the columns of ``like``."""
    return rows.select(*(F.col(f"row.`{c}`").alias(c) for c in like.columns))


def join_checked(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join with a smaller ``right`` side, which should be a stored table, as it is counted.

    Up to ``BROADCAST_ROWS`` rows it is broadcast. Beyond that both sides are shuffled, and a hot key of the left
    side is split by adaptive execution.
    """
    return left.join(F.broadcast(right) if right.count() <= BROADCAST_ROWS else right, on, how)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of ``edges`` (a, b); ``component`` is the smallest node reachable.

    Alternates large-star and small-star steps until nothing changes. Every step is a partially aggregated
    minimum and a join with unique keys on one side, and its result is stored, so a hub's rows are spread by
    adaptive skew handling and lost executors cost one step. Only two numbers reach the driver. Up to ``SMALL_EDGES``
    edges are one partition, where the steps need no shuffles.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now, before = stored(now, "edges"), None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or seen == before:
            break
        before = seen
        small = seen[0] <= SMALL_EDGES
        now = now.coalesce(1) if small else now
        now = stored(_star(_star(now, True, small), False, small), "edges")
    heads = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(heads)


def _star(edges: DataFrame, large: bool, small: bool) -> DataFrame:
    """One step on edges a > b; large: neighbours above a node go to its smallest neighbour, else those below.

    ``small``: the edges are one partition and stay so.
    """
    if large:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        both = both.coalesce(1) if small else both
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        moved = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.where("a <> b").distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    moved = moved.unionAll(least.select("a", F.col("m").alias("b")))
    return (moved.coalesce(1) if small else moved).distinct()


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: the row's place, from 0, in the order of ``order``, which must leave no ties.

    Rows are dealt by range, numbered in each partition, and shifted by what the partitions before hold;
    one number per partition is all that is gathered.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    local = stored(sorted_.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    local = local.withColumn("_part", F.shiftrightunsigned("_at", 33))
    counts = sorted((r["_part"], r["n"]) for r in local.groupBy("_part").agg(F.count("*").alias("n")).collect())
    offsets, total = [], 0
    for part, n in counts:
        offsets.append((part, total))
        total += n
    schema = StructType([StructField("_part", LongType()), StructField("_before", LongType())])
    before = F.broadcast(spark.createDataFrame(offsets, schema))  # one row per partition
    place = (F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias(name)
    return local.join(before, "_part").select(*(F.col(f"`{c}`") for c in df.columns), place)


def unit_interval(*columns: Column) -> Column:
    """A number in (0, 1) that is fixed by the columns: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws("|", *columns))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
