"""Every query with a SQL oracle matches DuckDB on the same parquet tables (sf0.001)."""

import duckdb
import pytest

from conftest import SF001
import __spark_entry__ as entry_mod
from scripts.oracle_check import TABLES, compare

ORACLE = entry_mod.oracle_sql()
QUERIES = entry_mod.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF001, name, QUERIES[name], ORACLE[name], con)
    assert r["status"] == "match", r


def test_entry_contract(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert df.columns == ["category_grouped", "n_items", "proportion_published", "size_rank"]
    assert len(rows) >= 1
    assert set(ORACLE) <= set(QUERIES)
