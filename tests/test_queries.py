"""Every registered query against its SQL oracle."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import rows_of
from tillroll.workload import oracle, registry

TINY = Path("/root/testdata/sf0.001")

EXPECTED_ROWS = {
    "csv_scan": 4599, "bronze_rows": 4599, "bronze_append": 4599, "silver_rows": 4599,
    "bronze_partitions": 1067, "gold_sales": 1473, "gold_customer": 150, "upsert_silver": 3995,
    "upsert_empty": 3931, "trigger_keys": 333, "catalog_gold": 1473, "layered_run": 150, "stream_customers": 150,
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in TINY.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def test_every_query_has_an_oracle():
    assert registry.queries().keys() == oracle.oracles().keys()
    assert registry.queries().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_oracle(spark, duck, name):
    frame = contract.queries()[name](spark, str(TINY))
    columns = sorted(frame.columns)
    oracle = duck.sql(contract.oracle_sql()[name])
    assert columns == sorted(oracle.columns)
    expected = oracle.select(*columns).fetchall()
    rows = rows_of(frame.select(*columns))
    assert rows == sorted(expected, key=repr)
    assert len(rows) == EXPECTED_ROWS.get(name, len(rows))


def test_entry(spark):
    assert contract.entry(spark).count() == 150


def test_the_library_stands_without_what_the_training_data_queries_need():
    """A module that is missing takes those queries away, and no others."""
    code = (
        "import sys; sys.modules['tiktoken'] = None\n"
        "import __spark_entry__ as c\n"
        "from tillroll.workload import registry\n"
        "assert c.queries().keys() == registry.queries().keys() == c.oracle_sql().keys()\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(contract.__file__).parent)
