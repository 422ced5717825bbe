"""Every query with SQL, against DuckDB on the smallest tables."""

import os

import pytest

from corpusloom.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or isinstance(value, float) and value != value or str(value) in ("NaT", "<NA>"):
        return None
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return str(bool(value))
    try:
        return f"{float(value):.6f}"
    except (TypeError, ValueError):
        return str(value)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert rows(catalog.queries()[name](spark, DATA).toPandas()) == rows(duck.sql(catalog.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    frame = catalog.queries()[name](spark, DATA)
    assert frame.columns and frame.count() >= 0
