"""Every registered query against its DuckDB oracle on the smallest tables.

The driver runs the same comparison at sf0.01 (``tools/compare.py`` does it
locally); sf0.001 keeps the suite fast.
"""

import os

import duckdb
import pytest

import __spark_entry__ as E
from starpipe.plans.oracle import oracle_sql
from starpipe.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tools.compare import SPARK_TO_DUCK, TABLES, digest

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(SQL[name])
    d_rows = rel.fetchall()
    assert len(s_rows) == len(d_rows)
    s_schema = sorted((f.name, SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()))
                      for f in df.schema.fields)
    assert s_schema == sorted(zip(rel.columns, [str(t) for t in rel.types]))
    assert digest(df.columns, s_rows) == digest(rel.columns, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "AttendanceFactKey" in df.columns
