from helpers import rows
from hypothesis import HealthCheck, given, settings, strategies as st

from contrail.operators import enrich
from contrail.operators.skew import hot_keys, split_join

LEFT, RIGHT = "a string, b int, n int", "x string, y int, v int"
KEYS = st.tuples(st.one_of(st.none(), st.sampled_from("pqr")), st.one_of(st.none(), st.integers(0, 1)))


def test_hot_keys_are_counted_in_pieces(spark):
    df = spark.createDataFrame([("f",)] * 5 + [("g",)] * 2 + [(None,)] * 9, "k string")
    assert rows(hot_keys(df, "k", rows=2)) == [("f", 3), (None, 5)]
    assert rows(hot_keys(df, "k", rows=1)) == [("f", 5), ("g", 2), (None, 9)]
    assert rows(hot_keys(df, "k")) == []


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(KEYS, max_size=30), st.lists(KEYS, max_size=8), st.sampled_from(["inner", "left"]), st.integers(1, 4))
def test_split_join_equals_join(spark, left_keys, right_keys, how, hot_rows):
    left = spark.createDataFrame([(*key, i) for i, key in enumerate(left_keys)], LEFT)
    right = spark.createDataFrame([(*key, i) for i, key in enumerate(right_keys)], RIGHT)
    plain = left.join(right, (left["a"] == right["x"]) & (left["b"] == right["y"]), how).select("a", "b", "n", "v")
    split = split_join(left, right, {"a": "x", "b": "y"}, hot_keys(left, "a", "b", rows=hot_rows), ["n"], how)
    assert split.columns == ["a", "b", "n", "v"]
    assert rows(split) == rows(plain)


def test_a_hot_flight_is_spread_over_tasks(spark):
    """No partition of the shuffled join holds all rows of the hot flight."""
    settings_ = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings_}
    for key, value in settings_.items():
        spark.conf.set(key, value)
    try:
        events = spark.range(2000).selectExpr("CAST(id AS STRING) AS id", "if(id % 3 = 0, 'hot', CAST(id AS STRING)) AS flight_id")
        flights = events.selectExpr("flight_id AS id", "DATE '2024-01-01' AS dof").distinct()
        joined = enrich.int_events(events, flights, hot_keys(events, "flight_id", rows=50))
        sizes = joined.where("flight_id = 'hot'").selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
        assert sum(r["count"] for r in sizes) == 667
        assert len(sizes) > 1
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
