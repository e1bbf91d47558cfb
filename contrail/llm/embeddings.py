"""Near-duplicate vectors by an inverted multi-index.

Vectors are normed and halved; each half has a codebook of its own, and the pairs of codes are a grid of cells.
Every vector is in the cell of its nearest codes and, as a query, visits the cells nearest to it in the order of
a multi-sequence traversal. How many cells it visits is measured: vectors of the sample are turned by exactly the
angle of the threshold in random directions, and as many cells are visited as find ``RECALL`` of the cells that
they came from. What meets in a cell is compared by cosine in double precision.

Codebooks are fitted on at most about ``SAMPLE`` vectors; every vector is indexed and is a query. The number of
codes follows the number of vectors, so that cells keep about ``OCCUPANCY`` vectors.

Equal vectors are one class with a count. A crowded cell is cut into pieces of its members and pieces of its
visitors, each pair of which is compared in a place of its own. Links are not listed: a place returns counts, and
a star for each set of vectors that its links connect.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite numbers link with nothing; vectors of
each length are compared among themselves, with an index of their own; rows with a null id link like others, and
a component is named by its smallest id, which is null if it has none; repeated rows link with each other like any
equal vectors; an empty table gives no row; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail.llm.common import components, join_checked, ship, stored

COSINE = 0.95
SAMPLE, OCCUPANCY, RECALL = 20_000, 8, 0.995
PROBES = 1_000  # sample vectors that measure the recall
ROUNDS = 12  # of k-means
MEMBERS, VISITORS = 1_000, 10_000  # of a cell that are compared in one place
BLOCK = 2_000  # visitors compared at a time


@dataclass
class Index:
    codes: tuple[np.ndarray, np.ndarray]  # a codebook for each half
    visits: int


def normed(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    # By the largest component first, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def _distances(half: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (half**2).sum(axis=1)[:, None] - 2 * half @ codes.T + (codes**2).sum(axis=1)


def _codebook(half: np.ndarray, k: int, generator: np.random.Generator) -> np.ndarray:
    codes = half[generator.choice(len(half), k, replace=False)]
    for _ in range(ROUNDS):
        nearest = _distances(half, codes).argmin(axis=1)
        n = np.bincount(nearest, minlength=k)
        sums = np.zeros_like(codes)
        np.add.at(sums, nearest, half)
        codes = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], codes)
    return codes


def fit(sample: np.ndarray, vectors: int, cosine: float = COSINE, recall: float = RECALL) -> Index:
    """Codebooks for ``vectors`` vectors from a sample, and the number of cells to visit."""
    generator = np.random.default_rng(8)
    k = int(max(1, min(np.ceil(np.sqrt(vectors / OCCUPANCY)), len(sample) // 8)))
    sample = normed(sample)
    middle = sample.shape[1] // 2
    codes = tuple(_codebook(half, k, generator) for half in (sample[:, :middle], sample[:, middle:]))
    if k == 1:
        return Index(codes, 1)
    probes = sample[generator.choice(len(sample), min(PROBES, len(sample)), replace=False)]
    away = generator.normal(size=probes.shape)
    away = normed(away - (away * probes).sum(axis=1, keepdims=True) * probes)
    turned = cosine * probes + np.sqrt(1 - cosine**2) * away
    own = [_distances(h, c).argmin(axis=1) for h, c in zip((probes[:, :middle], probes[:, middle:]), codes)]
    far = [_distances(h, c) for h, c in zip((turned[:, :middle], turned[:, middle:]), codes)]
    reach = sum(f[np.arange(len(probes)), o] for f, o in zip(far, own))
    other = np.sort(far[1], axis=1)
    ranks = [np.searchsorted(o, r - f, "left").sum() for f, o, r in zip(far[0], other, reach)]
    return Index(codes, int(min(k * k, np.quantile(ranks, recall, method="higher") + 1)))


def cells(index: Index, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(own cell, visited cells in order) of normed vectors.

    The first cells of a multi-sequence traversal are among those whose places in the two sorted lists of
    codes have a product within their number, so these are ordered by their summed distances.
    """
    k, middle = len(index.codes[0]), vectors.shape[1] // 2
    top = min(k, index.visits)
    lists = []
    for half, codes in zip((vectors[:, :middle], vectors[:, middle:]), index.codes):
        far = _distances(half, codes)
        near = np.argsort(far, axis=1, kind="stable")[:, :top]
        lists.append((near, np.take_along_axis(far, near, axis=1)))
    (one, far_one), (two, far_two) = lists
    own = one[:, 0].astype(np.int64) * k + two[:, 0]
    i, j = (a.ravel() for a in np.meshgrid(np.arange(top), np.arange(top), indexing="ij"))
    i, j = i[(i + 1) * (j + 1) <= index.visits], j[(i + 1) * (j + 1) <= index.visits]
    order = np.argsort(far_one[:, i] + far_two[:, j], axis=1, kind="stable")[:, : index.visits]
    visited = np.take_along_axis(one[:, i].astype(np.int64) * k + two[:, j], order, axis=1)
    return own, visited


def _connected(row: np.ndarray, column: np.ndarray, rows: int, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest row connected to each row and column by the links (row, column); rows itself where there is none."""
    of_row, of_column = np.arange(rows), np.full(columns, rows)
    while True:
        least = np.minimum(of_row[row], of_column[column])
        new_row, new_column = of_row.copy(), of_column.copy()
        np.minimum.at(new_row, row, least)
        np.minimum.at(new_column, column, least)
        if (new_row == of_row).all() and (new_column == of_column).all():
            return of_row, of_column
        of_row, of_column = new_row, new_column


class _Place:
    """The members of one piece of a cell; visitors pass by in blocks."""

    def __init__(self, cosine: float):
        self.cosine, self.key = cosine, None

    def settle(self, key: tuple, member: list[dict]) -> None:
        self.key = key
        self.ids = np.array([m["node"] for m in member])
        self.counts = np.array([m["n"] for m in member])
        self.visited = [set(m["visited"]) for m in member]
        self.vectors = np.array([np.frombuffer(m["vector"], np.float64) for m in member])

    def meet(self, visitor: list[dict]) -> list[tuple[int, int, int]]:
        """(node, links, connected node) of all that link here."""
        ids = np.array([v["node"] for v in visitor])
        vectors = np.array([np.frombuffer(v["vector"], np.float64) for v in visitor])
        row, column = np.nonzero(vectors @ self.vectors.T >= self.cosine)
        different = ids[row] != self.ids[column]
        row, column = row[different], column[different]
        if not len(row):
            return []
        counts = np.array([v["n"] for v in visitor])
        links = np.bincount(row, self.counts[column], len(ids))
        # A member counts a visitor here only if it doesn't visit that one's cell itself.
        own = [v["own"] for v in visitor]
        alone = np.array([own[r] not in self.visited[c] for r, c in zip(row, column)])
        back = np.bincount(column[alone], counts[row[alone]], len(self.ids))
        of_row, of_column = _connected(row, column, len(ids), len(self.ids))
        found = [(ids[r], links[r], ids[of_row[r]]) for r in np.unique(row)]
        found += [(self.ids[c], back[c], ids[of_column[c]]) for c in np.unique(column)]
        return [(int(a), int(b), int(c)) for a, b, c in found]


def _compare(places: DataFrame, cosine: float) -> DataFrame:
    """(node, links, other): what the places of (cell, part, piece) find; members sort before visitors."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, key, members, visitors = _Place(cosine), None, [], []

        def met() -> Iterator[pa.RecordBatch]:
            if members and visitors:
                if place.key != key:
                    place.settle(key, members)
                found = place.meet(visitors)
                if found:
                    names = ["node", "links", "other"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names)

        for batch in batches:
            for row in batch.to_pylist():
                if key != (row["cell"], row["part"], row["piece"]):
                    yield from met()
                    key, members, visitors = (row["cell"], row["part"], row["piece"]), [], []
                (visitors if row["visitor"] else members).append(row)
                if len(visitors) == BLOCK:
                    yield from met()
                    visitors = []
        yield from met()

    keys = ["cell", "part", "piece"]
    places = places.repartition(*keys).sortWithinPartitions(*keys, "visitor")
    return places.mapInArrow(compare, "node long, links long, other long")


def near_vectors(rows: DataFrame, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of ``rows`` (vec_id, embedding)."""
    spark = rows.sparkSession
    ship(spark)
    rows = rows.select(F.col("`vec_id`").cast("long").alias("vec_id"), F.col("`embedding`").cast("array<double>").alias("v"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    sound = ~F.exists("v", odd) & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    classes = rows.where("sound").groupBy("v").agg(F.count("*").alias("n"), F.min("vec_id").alias("first"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    found = classes.select("node", F.lit(0).cast("long").alias("links"), F.col("node").alias("other")).limit(0)
    for length in sorted(classes.groupBy(F.size("v").alias("length")).count().collect()):  # a row for each length
        alike = classes.where(F.size("v") == length["length"])
        found = found.unionByName(stored(_found(alike, length["count"], cosine, recall), "found"))

    joined = stored(components(found.select(F.col("node").alias("a"), F.col("other").alias("b"))), "components")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    classes = classes.join(links, "node", "left").join(joined, "node", "left")
    classes = stored(classes.withColumn("component", F.coalesce("component", "node")), "joined")
    least = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = classes.join(least, "component").select(
        F.col("v").alias("_v"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    rows = rows.join(classes, F.when(F.col("sound"), F.col("v")) == F.col("_v"), "left")
    rows = rows.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return rows.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _found(classes: DataFrame, size: int, cosine: float, recall: float) -> DataFrame:
    """(node, links, other) of the links among ``size`` classes of one length, by an index of their own."""
    draw = F.pmod(F.xxhash64("v"), F.lit(1_000_000)) / 1_000_000
    sample = classes.where(draw < min(1.0, SAMPLE / size)).select("v").toPandas()["v"]
    if len(sample) == 0:
        sample = classes.select("v").limit(1).toPandas()["v"]
    return _places(classes, fit(np.stack(sample), size, cosine, recall), cosine)


def _places(classes: DataFrame, index: Index, cosine: float) -> DataFrame:
    """Index all classes, let all visit their cells, and compare."""
    shared = classes.sparkSession.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                flat = part.column(2).flatten().to_numpy()
                vectors = normed(flat.reshape(part.num_rows, -1))
                own, visited = cells(shared.value, vectors)
                columns = [part.column(0), part.column(1), pa.array([v.tobytes() for v in vectors], pa.binary())]
                columns += [pa.array(own), pa.array(list(visited), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["node", "n", "vector", "own", "visited"])

    schema = "node long, n long, vector binary, own long, visited array<long>"
    placed = stored(classes.select("node", "n", "v").mapInArrow(assign, schema), "index")
    members = placed.groupBy(F.col("own").alias("cell")).agg(F.ceil(F.count("*") / MEMBERS).alias("parts"))
    visits = placed.select(F.explode("visited").alias("cell")).groupBy("cell")
    visits = visits.agg(F.ceil(F.count("*") / VISITORS).alias("pieces"))
    # Cells that are cut; no more than a thousandth of the vectors.
    cut = stored(members.join(visits, "cell").where("parts > 1 OR pieces > 1"), "crowded")
    last = lambda c: F.coalesce(c, F.lit(1)) - 1
    spot = F.xxhash64("node")
    own = join_checked(placed.withColumnRenamed("own", "cell"), cut, ["cell"], "left")
    own = own.select(
        "cell", F.pmod(spot, F.coalesce("parts", F.lit(1))).alias("part"),
        F.explode(F.sequence(F.lit(0).cast("long"), last("pieces"))).alias("piece"), F.lit(False).alias("visitor"),
        "node", "n", "vector", F.col("cell").alias("own"), "visited",
    )
    visitors = placed.withColumn("cell", F.explode("visited")).drop("visited")
    visitors = join_checked(visitors, cut, ["cell"], "left")
    visitors = visitors.select(
        "cell", F.explode(F.sequence(F.lit(0).cast("long"), last("parts"))).alias("part"),
        F.pmod(spot, F.coalesce("pieces", F.lit(1))).alias("piece"), F.lit(True).alias("visitor"),
        "node", "n", "vector", "own", F.lit(None).cast("array<long>").alias("visited"),
    )
    return _compare(own.unionByName(visitors), cosine)


def op8_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))
