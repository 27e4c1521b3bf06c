"""Every query of the core against its SQL on the small tables."""

import glob
import math
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from lanefold.plans.registry import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def rows(df):
    def plain(v):
        if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and math.isnan(v):
            return None
        if isinstance(v, (int, float, np.integer)) and not isinstance(v, bool) or type(v).__name__ == "Decimal":
            return float(f"{float(v):.9g}")
        return str(v)

    df = df[sorted(df.columns)]
    return sorted((tuple(map(plain, r)) for r in df.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
