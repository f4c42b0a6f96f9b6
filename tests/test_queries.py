"""The registry: names, flagship, and agreement with SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, table
from tests.conftest import DATA
from tidewatch.plans.oracle import oracle
from tidewatch.plans.queries import REGISTRY

STREAMS = [name for name in REGISTRY if name.startswith("stream_")]
SLOW = {"alerts_sliding", *STREAMS}


def test_every_query_has_sql():
    assert set(REGISTRY) == set(oracle())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "window_start" and df.count() > 0


@pytest.mark.parametrize("name", [name for name in REGISTRY if name not in SLOW])
def test_query_agrees_with_sql(spark, name):
    df = contract.queries()[name](spark, DATA)
    db = duckdb.connect()
    for source in TABLES:
        db.execute(f"CREATE VIEW {source} AS SELECT * FROM '{DATA}/{source}.parquet'")
    result = db.execute(contract.oracle_sql()[name])
    theirs = table([d[0] for d in result.description], result.fetchall())
    assert table(df.columns, df.collect()) == theirs
