import random

from cases import classes
from pyspark.sql import functions as F

from contrail.llm import common, queries


def test_components_match_union_find(spark):
    generator = random.Random(5)
    links = [(generator.randrange(300), generator.randrange(300)) for _ in range(160)]
    links += [(1000, 1000 + i) for i in range(60)] + [(2000 + i, 2001 + i) for i in range(25)] + [(7, 7)]
    found = common.components(spark.createDataFrame(links, "a long, b long"))
    linked = {n for link in links for n in link if link[0] != link[1]}
    want = classes({n for link in links for n in link}, links)
    assert {r["node"]: r["component"] for r in found.collect()} == {n: want[n] for n in linked}


def test_components_of_nothing(spark):
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ranked_is_the_global_order(spark):
    names = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("name"), F.lit(1).alias("x"))
    found = common.ranked(names, [F.col("name")], "place").orderBy("place").collect()
    assert [r["place"] for r in found] == list(range(500))
    assert [r["name"] for r in found] == sorted(r["name"] for r in found)


def test_join_checked_gives_the_same_either_way(spark, monkeypatch):
    left = spark.range(100).select(F.when(F.col("id") < 60, 7).otherwise(F.col("id")).alias("k"), "id")
    right = common.stored(spark.range(80).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), "right")
    small = common.join_checked(left, right, ["k"], "left")
    monkeypatch.setattr(common, "BROADCAST_ROWS", 10)
    large = common.join_checked(left, right, ["k"], "left")
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.queries()) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_small_components_are_those_of_shuffled_steps(spark, monkeypatch):
    generator = random.Random(3)
    edges = spark.createDataFrame([(generator.randrange(300), generator.randrange(300)) for _ in range(170)], "a long, b long")
    small = sorted(map(tuple, common.components(edges).collect()))
    monkeypatch.setattr(common, "SMALL_EDGES", 0)
    assert sorted(map(tuple, common.components(edges).collect())) == small


def test_small_batches_leave_a_choice_of_the_session(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        for given, wanted in (("10000", str(common.BATCH_ROWS)), ("300", "300")):
            spark.conf.set(name, given)
            common.small_batches(spark)
            assert spark.conf.get(name) == wanted
    finally:
        spark.conf.set(name, before)


def test_a_lean_function_gives_its_batches_and_returns_memory(monkeypatch):
    pool = common.pa.default_memory_pool()
    released, batches = [], [common.pa.record_batch({"a": [i]}) for i in range(3)]

    def counted(given):
        for batch in given:
            assert not released
            yield batch

    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: released.append(1) or pool)
    assert list(common.lean(counted)(iter(batches))) == batches
    assert released == [1]
