"""The driver's check: every catalogued query against its DuckDB SQL (small scale)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from opslens.plans.catalogue import QUERIES
from opslens.plans.oracle import ORACLE
from tools.compare import TABLES, digest

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(df.columns, s_rows)[0] == digest(o_cols, o_rows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["machine_id", "alert_type", "score", "timestamp",
                                              "recommended_action"]
