import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from contrail.session import local_session

    return local_session(4, "tests")


@pytest.fixture
def database(spark, tmp_path):
    """A database of its own for stored tables."""
    name = "t_" + "".join(c for c in tmp_path.name if c.isalnum())
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")
