"""Every registered query against its DuckDB oracle (sf0.001 here; tools/oracle_check.py for sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from celltide.plans.registry import ORACLES, QUERIES
from tools.oracle_check import rows_of

from locations import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    s = QUERIES[name](spark, SF_SMALL).toPandas()
    d = con.execute(ORACLES[name]).df()
    sc, sr = rows_of(s)
    dc, dr = rows_of(d)
    assert sc == dc
    assert sr == dr


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["row_key", "family", "qualifier", "value"]
    assert df.count() > 0
    assert os.path.isdir(SF_SMALL)


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "binary": "BLOB"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_column_types_match_oracle(spark, con, name):
    s = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in QUERIES[name](spark, SF_SMALL).schema.fields}
    rel = con.sql(ORACLES[name])
    assert s == dict(zip(rel.columns, [str(t) for t in rel.types]))
