import duckdb
import pytest

import __spark_entry__ as entry
from candlewick import queries as core

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def lines(df, cols):
    return sorted(map(str, df[cols].astype(object).where(df[cols].notna(), None).values.tolist()))


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got, want = core.QUERIES[name](spark, SF).toPandas(), duck.sql(core.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert lines(got, sorted(got.columns)) == lines(want, sorted(want.columns))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(core.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_plans_push_down(spark):
    plan = core.range_split(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "props" not in plan.split("ReadSchema")[1]
