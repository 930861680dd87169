"""Every registered query against its SQL on the same tables, and the reference's own operators on small cases."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

from .conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    def told(v):
        v = v.tolist() if hasattr(v, "tolist") else v
        if isinstance(v, (list, tuple)):
            return str([told(x) for x in v])
        if v is None or v is pd.NaT or v is pd.NA or v != v:
            return "null"
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(told(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got, want = entry.queries()[name](spark, SF).toPandas(), duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
