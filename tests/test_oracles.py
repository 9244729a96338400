"""Every registered query against its SQL, on whole tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from fathomline.plans.catalogue import QUERIES, SQL


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def ordered(df):
    df = df[sorted(df.columns)]
    as_text = df.astype(object).where(df.notna(), None).map(lambda v: "" if v is None else str(v))
    return df.iloc[as_text.sort_values(list(as_text.columns)).index].reset_index(drop=True)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, db):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = db.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    pd.testing.assert_frame_equal(ordered(got), ordered(want), check_dtype=False, rtol=1e-9, atol=1e-9)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
