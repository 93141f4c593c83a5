"""Every registered query with oracle SQL matches DuckDB on the sf0.001 tables
(row count, column names, order-insensitive values); the others run."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
SF = "/root/testdata/sf0.01"   # the correctness scale of the driver

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def v(x):
        if isinstance(x, float) and math.isnan(x):
            return "nan"
        return repr(x)
    return sorted("|".join(v(r[i]) for i in order) for r in rows)


ORACLE = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert df.columns
        return
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _norm(rows, df.columns) == _norm(orows, ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 11


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_single_task_window(spark, name):
    """No registered query plans a window without a partition key."""
    from rigcast.plans.inspect import unpartitioned_windows
    df = entry.queries()[name](spark, SF)
    assert unpartitioned_windows(df, data_columns=set(df.columns) | {"idx", "value", "_rid"}) == []
