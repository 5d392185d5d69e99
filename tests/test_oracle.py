"""Every registered query with a SQL counterpart, run in both engines over whole tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import TABLES, canonical
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["brand", "predicted_sales", "last_month_sales", "growth", "growth_pct", "trend"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, con, name):
    df = queries()[name](spark, SF)
    cur = con.execute(oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert canonical(df.collect(), df.columns) == canonical(cur.fetchall(), names)
