"""Every registered query against its DuckDB statement, and the shape of its plan."""

import math
from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from contrail.plans import model_tests, oracles, registry

QUERIES, ORACLES = registry.queries(), oracles.oracle_sql()
DUCKDB_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}
STREAMS = [name for name in QUERIES if name.startswith(("stream_", "stored_", "monthly_run", "period_run"))]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(value(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    expected_types = {d[0]: str(d[1]) for d in cursor.description}
    assert sorted(df.columns) == sorted(columns)
    assert {c: DUCKDB_TYPES[t] for c, t in df.dtypes} == expected_types
    assert comparable(df.collect(), df.columns) == comparable(cursor.fetchall(), columns)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STREAMS])
def test_plan_stays_in_the_engine(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in plan


def test_entry(spark):
    assert contract.entry(spark).count() == 19


def test_declared_models_are_all_registered():
    assert {f"tests_{model}" for model in model_tests.DECLARED} <= set(QUERIES)
    assert len(model_tests.DECLARED) == 20
