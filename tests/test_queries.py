"""Every driver query against its SQL equivalent in DuckDB."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import compare as comparison  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from hourledger.plans.oracles import ORACLES  # noqa: E402
from hourledger.plans.queries import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def db():
    import duckdb

    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["userId", "total_billable_hours"] and df.count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    got = comparison.normal(df.columns, [tuple(row) for row in df.collect()])
    cursor = db.execute(ORACLES[name])
    assert got == comparison.normal([item[0] for item in cursor.description], cursor.fetchall())
