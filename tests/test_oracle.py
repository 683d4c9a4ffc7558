"""Every registered query against its DuckDB oracle on the sf0.001 tables
(row count, column names and an order-insensitive value hash), plus the
entry smoke check."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.compare import TABLES, digest, type_mismatches

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    from turnout.plans import catalog
    assert set(catalog.registry()) <= set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert type_mismatches(df.dtypes, rel.columns, rel.types) == []
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(rel.columns, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["activity_id", "start_at", "lok_amount_players", "lok_amount_leaders"]
    assert df.count() > 0
