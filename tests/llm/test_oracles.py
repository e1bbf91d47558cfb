"""The queries that SQL can express against their statements, and all of them against the driver's contract."""

from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from contrail.llm import decontamination, queries

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def test_all_are_registered():
    assert {*queries.queries(), "pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_matches_its_statement(spark, name):
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    cursor = connection.execute(queries.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    df = contract.queries()[name](spark, SF_DIR)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert sorted(map(repr, map(tuple, df.select(list(types)).collect()))) == sorted(map(repr, cursor.fetchall()))


def test_the_statement_joins_every_item_that_holds_a_window(spark):
    """Two items that share windows, and one that repeats its own, with documents that hold them."""
    shared = " ".join(f"w{i}" for i in range(21))
    items = [(7, shared + " " + " ".join(f"x{i}" for i in range(20))), (3, shared + " y1 y2 y3"), (4, f"{shared} z {shared}"), (5, "a b c d e f"), (6, "a b c d e f")]
    docs = [(1, items[0][1]), (2, f"before {shared} after"), (8, "say a b c d e f here"), (9, "nothing of it"), (10, None)]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    connection.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    cursor = connection.execute(queries.oracle_sql()["op1_decontamination"])
    columns = [d[0] for d in cursor.description]
    found = decontamination.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert sorted(map(repr, map(tuple, found.select(columns).collect()))) == sorted(map(repr, cursor.fetchall()))
