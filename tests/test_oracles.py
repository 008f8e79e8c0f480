"""Every registered query against its DuckDB oracle at sf0.001 (the driver
gate runs the same comparison at sf0.01 via scripts/check_oracles.py)."""

import duckdb
import pytest

import __spark_entry__ as entry
from tablelearn.sources.tables import TABLES

from .conftest import SF001

from tablelearn.plans.registry import ORACLES as CORE_ORACLES, QUERIES as CORE_QUERIES

QUERIES = {k: v for k, v in entry.queries().items() if k in CORE_QUERIES}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in CORE_ORACLES}
ROWS_ONLY = {"g19_gmm_wide", "g15_linear_svc"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_rows_only():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["vec_id", "label", "prediction", "probability"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF001)
    cols = sorted(sdf.columns)
    srows = sorted(tuple(r[c] for c in cols) for r in sdf.collect())
    rel = con.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    drows = sorted(tuple(r[i] for i in idx) for r in rel.fetchall())
    assert srows == drows
