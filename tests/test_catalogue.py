import os

import duckdb
import pytest

import __spark_entry__ as contract
from tidegraph.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


@pytest.fixture(scope="module")
def tables():
    found = duckdb.connect()
    for name in TABLES:
        found.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return found


def plain(rows):
    return sorted(tuple(repr(round(v, 6)) if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_its_sql(spark, tables, name):
    df = catalogue.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    found = tables.execute(catalogue.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = plain(tuple(r[i] for i in order) for r in found.fetchall())
    assert plain(tuple(r) for r in df.select(*(f"`{c}`" for c in columns)).collect()) == want


def test_entry_and_names(spark):
    assert contract.entry(spark).columns == ["region", "month", "n", "total"]
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_filters_reach_the_scan(spark):
    plan = catalogue.QUERIES["filter_gt"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice,100000" in plan
