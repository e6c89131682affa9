"""Each query of the core against its SQL on the smallest data."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from tracewright import queries as core

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def normal(df):
    def cell(v):
        if isinstance(v, float):
            return None if v != v else f"{v:.9g}"
        return None if v is None or v is pd.NaT or v is pd.NA else str(v)

    return sorted((tuple(cell(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(core.queries()))
def test_query(spark, db, name):
    got = core.queries()[name](spark, SF).toPandas()
    sql = core.oracle_sql().get(name)
    if sql:
        want = db.sql(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert normal(got) == normal(want)
