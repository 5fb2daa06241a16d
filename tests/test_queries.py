"""Every catalogue query against its SQL in an independent engine."""

import duckdb
import pandas as pd
import pytest

from catalog_spark import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(x):
    return "<null>" if pd.isna(x) else repr(round(float(x), 9)) if isinstance(x, float) else str(x)


def rows(pdf):
    return sorted(tuple(map(_plain, r)) for r in pdf[sorted(pdf.columns)].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = duck.sql(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
