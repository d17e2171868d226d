"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import rows_of  # noqa: E402
from tallyframe.plans.catalogue import QUERIES  # noqa: E402
from tallyframe.sources.tables import TABLE_NAMES  # noqa: E402

SF = os.environ.get("TALLYFRAME_ORACLE_SF", "/root/testdata/sf0.001")
ORACLES = {name: sql for name, sql in E.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


# DuckDB result type → Spark type name.
DUCK_TO_SPARK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
                 "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLES[name])
    o_cols, o_types = rel.columns, [str(t) for t in rel.types]
    o_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert {c: DUCK_TO_SPARK.get(t, t) for c, t in zip(o_cols, o_types)} == spark_types
    assert rows_of(df.columns, s_rows, None) == rows_of(o_cols, o_rows, None)   # bit-exact doubles


def test_entry_runs(spark):
    out = E.entry(spark)
    assert out.columns == ["r_regionkey", "median", "percentile_80th", "percentile_95th"]
    assert out.count() == 5
