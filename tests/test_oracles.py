"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from farebox.plans import catalog
from scripts.check_oracles import TABLES, rows_of

from .conftest import SF0001

# the library's own queries; optional subpackages have tests of their own
QUERIES = catalog.all_queries()
ORACLES = catalog.all_oracles()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


def test_every_query_is_registered_with_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert len(QUERIES) >= 69
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    sp = QUERIES[name](spark, SF0001).toPandas()
    dp = con.execute(ORACLES[name]).df()
    c1, r1 = rows_of(sp)
    c2, r2 = rows_of(dp)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 4 and set(df.columns) >= {"trip_category", "nb_trips", "revenue_per_min"}
