"""Every query with SQL against DuckDB on the smallest tables."""

import math

import duckdb
import pytest

from sedimenta.plans.registry import QUERIES, SQL

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    conn = duckdb.connect()
    for t in TABLES:
        conn.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return conn


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return round(float(value), 9) if isinstance(value, (int, float)) and not isinstance(value, bool) else value


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DIR)
    want = duck.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    rows = sorted((tuple(plain(r[c]) for c in sorted(names)) for r in got.collect()), key=str)
    at = [names.index(c) for c in sorted(names)]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_one_edit_neighbours_on_repeated_and_null_keys(spark, tmp_path):
    rows = [(1, "old rod"), (1, "cold rod"), (2, "cold rod"), (None, "old rod"), (3, None), (4, ""), (5, "a")] + [(100 + i, "gear") for i in range(40)] + [(200 + i, "gears") for i in range(30)]
    spark.createDataFrame(rows, "p_partkey long, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    conn = duckdb.connect()
    conn.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    for t in ("pages",):
        conn.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want = sorted(conn.execute(SQL["one_edit_neighbours"]).fetchall())
    assert sorted(tuple(r) for r in QUERIES["one_edit_neighbours"](spark, str(tmp_path)).select("a", "b").collect()) == want and len(want) == 1202
