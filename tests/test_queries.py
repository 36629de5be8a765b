"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from tidemark.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(x):
    if pd.isna(x):
        return None
    if isinstance(x, float) and x == int(x):
        return int(x)
    return x


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(str(tuple(cell(x) for x in r)) for r in df.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_equals_sql(spark, con, name):
    got = registry.QUERIES[name](spark, FOLDER).toPandas()
    want = con.sql(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_stream_takes_files_in_any_order(spark, con, tmp_path):
    (tmp_path / "events.parquet").mkdir()
    for k in (3, 0, 2, 1):  # quarters of the rows by time
        part = f"SELECT * EXCLUDE q FROM (SELECT *, ntile(4) OVER (ORDER BY ts) - 1 AS q FROM events) WHERE q = {k}"
        con.sql(f"COPY ({part}) TO '{tmp_path}/events.parquet/{k}.parquet'")
    got = registry.QUERIES["stream_equals_batch"](spark, str(tmp_path), files_per_batch=1).toPandas()
    assert rows(got) == rows(con.sql(registry.ORACLE_SQL["stream_equals_batch"]).df())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
