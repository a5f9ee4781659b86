"""A few registered queries against their DuckDB oracle on the smallest
tables (the full comparison is scripts/compare_oracle.py)."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from scripts.compare_oracle import TABLES, canon

CHEAP = ["psi_numeric", "chi_square_categorical", "drift_report", "auc_exact", "hash_split",
         "category_index", "run_series", "family_features"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("name", CHEAP)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[name])
    srows = [tuple(r) for r in sdf.collect()]
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert canon(sdf.columns, srows) == canon(rel.columns, drows)
