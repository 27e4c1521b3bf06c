"""Percentiles by narrowing histograms against Spark's own."""

import math

import pytest
from pyspark.sql import functions as F

from lanefold.operators.quantiles import percentiles

SHARES = {"min": 0.0, "q1": 0.25, "med": 0.5, "p9": 0.9, "max": 1.0}


def rows(spark):
    x = F.xxhash64("id")
    t = spark.range(3000).select(
        F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 7 < 5, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"),
        F.when(F.col("id") % 11 == 0, None).otherwise((x % 1000) / 8).alias("a"), F.pow(F.lit(10.0), (x % 9).cast("double")).alias("b"), F.when(F.col("id") % 13 > 0, (F.col("id") % 3).cast("int")).alias("c"),
    )
    more = spark.createDataFrame([("none", None, None, None), ("one", 5.0, -1e9, 7), ("nan", float("nan"), 1e9, 1), ("nan", 2.0, -1e9, 1)], "g string, a double, b double, c int")
    return t.unionByName(more)


@pytest.mark.parametrize(("bins", "most"), [(256, 20), (4096, 1 << 16)])
def test_equal_to_percentile(spark, bins, most):
    t = rows(spark).cache()
    real = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c))
    want = {r["g"]: r for r in t.groupBy("g").agg(*[F.percentile(real(c), q).alias(f"{c}_{n}") for c in "abc" for n, q in SHARES.items()]).collect()}
    got = {r["g"]: r for r in percentiles(t, ["g"], ["a", "b", "c"], SHARES, bins_of=bins, most=most).collect()}
    assert got.keys() == want.keys() and None in got
    for g, r in want.items():
        for c, v in r.asDict().items():
            if c != "g":
                assert (got[g][c] is None) == (v is None) and (v is None or math.isclose(got[g][c], v, rel_tol=1e-12)), (g, c)
    (all_,) = percentiles(t, [], ["a"], {"med": 0.5}, bins_of=bins, most=most).collect()
    assert all_["a_med"] == t.agg(F.percentile(real("a"), 0.5)).head()[0]


def test_edges(spark):
    empty = spark.createDataFrame([], "g string, a double")
    assert percentiles(empty, ["g"], ["a"], SHARES).collect() == [] and percentiles(empty, [], ["a"], {"m": 0.5}).collect()[0]["a_m"] is None
    with pytest.raises(ValueError):
        percentiles(empty, [], ["a"], {"m": 1.5})
