"""Every query with SQL returns what DuckDB returns on the same files."""

import duckdb
import pandas as pd
import pytest

from noticeweave.plans.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for name in TABLES:
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return c


def plain(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    rows = [tuple(None if x is None or x is pd.NaT or isinstance(x, float) and x != x else (float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)) for x in row) for row in df.itertuples(index=False)]
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_duckdb(spark, duck, name):
    mine, theirs = QUERIES[name](spark, FOLDER).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert plain(mine) == plain(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
