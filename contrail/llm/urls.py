"""URL filters by a sort-merge range join.

A host becomes a key by reversing its labels and ending each with a dot: ``a.b.org`` is ``org.b.a.``. A rule's
host and all its subdomains are then the keys that begin with the rule's key, an interval, and intervals nest.
Rules and URLs are cut into ranges of keys; a rule goes to every range that its interval touches. Each range is
sorted and swept once: a stack holds the rules whose interval is open, the most special on top, and a URL takes
from it the longest rule that fits its path too.

Ranges are cut by a bounded sample of the URLs, at most about ``SAMPLED`` for each range, with a number made
from the row beside the key, so that a host with a large share of all rows fills several ranges.

A rule (host, path) fits its host and all subdomains where the URL's path begins with the rule's path. Longest is
the most characters of host and path together, then of the host. Of equal rules, block wins.

Defined cases: a null URL, or one without ``://``, has an empty host and path, and no rule fits it; neither does
any rule fit an empty path, as a rule's path has a slash at least; rules with a null host, path or verdict are
left out; very long URLs, ties and repeated rows need no special care; an empty table of either kind is fine;
rows keep all their columns, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from contrail.llm.common import ship

SAMPLED = 20
RULES = [  # of the registered query
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    """Host, with A-Z lower-cased, and path; both empty without ``://``."""
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def host_key(host: str | Column) -> Column:
    """The labels of a host from the last to the first, each with a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


class _Open:
    """A rule host whose interval is open, with its rules by path."""

    def __init__(self, key: str, host: str):
        self.key, self.host, self.rules = key, host, {}

    def add(self, path: str, verdict: str) -> None:
        if self.rules.get(path) != "block":
            self.rules[path] = verdict
        self.lengths = sorted({len(p) for p in self.rules}, reverse=True)

    def longest(self, path: str) -> str | None:
        return next((path[:n] for n in self.lengths if path[:n] in self.rules), None)


def _sweep(rows: Iterator[dict]) -> Iterator[tuple[str | None, str | None]]:
    """(rule, verdict) of each URL of sorted ``rows``; rules, with a verdict, come before URLs of their key."""
    stack: list[_Open] = []
    part = None
    for row in rows:
        if row["part"] != part:
            part, stack = row["part"], []
        while stack and not row["key"].startswith(stack[-1].key):
            stack.pop()
        if row["verdict"] is not None:
            if not stack or stack[-1].key != row["key"]:
                stack.append(_Open(row["key"], row["host"]))
            stack[-1].add(row["path"], row["verdict"])
            continue
        best = None
        for level in stack:  # from the shortest host to the longest, which wins ties
            path = level.longest(row["path"])
            if path is not None and (best is None or len(level.host) + len(path) >= len(best[0].host) + len(best[1])):
                best = level, path
        yield (best[0].host + best[1], best[0].rules[best[1]]) if best else (None, None)


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(row, host, path, rule, verdict): each row of ``pages`` (url, ...) as a struct, with the longest rule that fits.

    ``rules`` has host, path and verdict; ``default`` is the verdict where no rule fits.
    """
    spark = pages.sparkSession
    ship(spark)
    host, path = host_and_path("`url`")
    row = F.struct(*(F.col(f"`{c}`") for c in pages.columns)).alias("row")
    urls = pages.select(row, F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    urls = urls.select(
        "row", "host", "path", host_key("host").alias("key"), F.xxhash64("row").alias("spot"),
        F.lit(None).cast("string").alias("verdict"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, SAMPLED * parts / max(pages.count(), 1))
    draw = F.pmod(F.xxhash64("key", "spot"), F.lit(1_000_000)) / 1_000_000
    sample = sorted((r["key"], r["spot"]) for r in urls.where(draw < share).select("key", "spot").collect())
    edges = [sample[i * len(sample) // parts] for i in range(1, parts)] if sample else []

    known = rules.dropna(subset=["host", "path", "verdict"])
    known = known.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
    known = known.withColumn("key", host_key("host"))
    # The rows' struct is null in a rule; nothing else about its type matters here.
    empty = F.lit(None).cast(urls.schema["row"].dataType)
    known = known.select(empty.alias("row"), "host", "path", "key", F.lit(0).cast("long").alias("spot"), "verdict")

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, part = [], []
            keys, spots, verdicts = (batch.column(i).to_pylist() for i in (3, 4, 5))
            for i, (key, spot, verdict) in enumerate(zip(keys, spots, verdicts)):
                if verdict is None:
                    first = last = bisect_right(edges, (key, spot))
                else:  # every range from the key to the end of its interval
                    first, last = bisect_left(edges, (key,)), bisect_left(edges, (key[:-1] + "/",))
                at += [i] * (last - first + 1)
                part += range(first, last + 1)
            taken = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(part, pa.int64())], names)

    names = ["row", "host", "path", "key", "spot", "verdict", "part"]
    schema = StructType([*(StructField(f.name, f.dataType) for f in urls.schema), StructField("part", LongType())])
    placed = urls.mapInArrow(parted, schema).unionByName(known.mapInArrow(parted, schema))
    order = ["part", "key", F.col("verdict").asc_nulls_last(), "path"]
    placed = placed.repartition(parts, "part").sortWithinPartitions(*order)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def rows() -> Iterator[dict]:
            for batch in batches:
                waiting.append(batch)
                yield from batch.select(["part", "key", "host", "path", "verdict"]).to_pylist()

        found = _sweep(rows())
        while True:
            first = next(found, None)
            if first is None:
                return
            batch = waiting[-1]
            urls_at = batch.column(5).is_null()
            chosen = [first]
            while len(chosen) < urls_at.true_count:
                chosen.append(next(found))
            waiting.clear()
            mine = batch.filter(urls_at)
            rule, verdict = (pa.array(c, pa.string()) for c in zip(*chosen))
            columns = [mine.column(0), mine.column(1), mine.column(2), rule, verdict.fill_null(default)]
            yield pa.RecordBatch.from_arrays(columns, ["row", "host", "path", "rule", "verdict"])

    out = urls.select("row", "host", "path").schema.add("rule", StringType()).add("verdict", StringType())
    return placed.mapInArrow(sweep, out)


def op9_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = judged(pages, rules)
    return found.select("row.page_id", "host", "path", "rule", "verdict")
