"""Exact percentiles of groups of any size, by narrowing histograms.

Values are counted first. Then the range that holds each wanted rank is cut into bins, the bins are counted, and the
bin of the rank becomes the next range, until it has few different values, which are ranked. Tasks hold counts of bins and
bounded ranges, so memory doesn't grow with the rows; a large group is spread over all tasks, as its values are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanefold.functions.shared import written

#: Bins of a range, and different values of a range that are ranked at once.
BINS, MOST = 1 << 12, 1 << 20


def _same(a: str, b: str, names: list[str]) -> list[Column]:
    return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names]


def _inside(counted: DataFrame, ranges: DataFrame, key: list[str]) -> DataFrame:
    """The counted values that lie in any range, with the range."""
    spans = ranges.select(*key, "_lo", "_hi").distinct()
    t = counted.alias("v").join(spans.alias("s"), [*_same("v", "s", key), F.col("v._v").between(F.col("s._lo"), F.col("s._hi"))])
    return t.select(*[F.col(f"v.{c}").alias(c) for c in key], "s._lo", "s._hi", "v._v", "v._k")


def _ranked(ranges: DataFrame, parts: DataFrame, key: list[str], order: str) -> DataFrame:
    """Ranges (o) and their part (b) that holds the wanted rank; ``_past`` is how many values lie in the parts before."""
    along = Window.partitionBy(*key, "_lo", "_hi").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_past", F.coalesce(F.sum("_m").over(along), F.lit(0)))
    rank = F.col("o._r") - F.col("o._before")
    return ranges.alias("o").join(parts.alias("b"), [*_same("o", "b", [*key, "_lo", "_hi"]), (rank >= F.col("b._past")) & (rank < F.col("b._past") + F.col("b._m"))])


def percentiles(rows: DataFrame, by: list[str], columns: list[str], shares: dict[str, float], digits: int | None = None, bins_of: int = BINS, most: int = MOST, weight: str | None = None) -> DataFrame:
    """``by`` and, for each column and share, ``<column>_<name>``: the percentile, interpolated between neighbours.

    Nulls and NaN are left out; a group without any value has nulls. Equal to Spark's ``percentile`` and to
    ``quantile_cont``. ``digits`` rounds; ``weight`` is a column that tells for how many rows a row stands. Without ``by`` there is one row. Some jobs run at once: one that counts the values, and one or a
    few that narrow the ranges (none for up to ``most`` different values, one or two for evenly spread ones).
    """
    if not all(0 <= q <= 1 for q in shares.values()):
        raise ValueError("shares lie between 0 and 1")
    key = [*by, "_c"]
    melted = F.explode(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in columns])).alias("_x")
    times = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    values = rows.select(*by, times.alias("_w"), melted).select(*by, "_w", "_x._c", "_x._v").filter("_v is not null and not isnan(_v) and _w > 0")
    counted = written(values.groupBy(*key, "_v").agg(F.sum("_w").alias("_k")), "values")
    ranges = counted.groupBy(*key).agg(F.sum("_k").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("_d"))
    place = lambda q: (F.col("_n") - 1) * F.lit(float(q))
    ranks = F.explode(F.array_distinct(F.flatten(F.array(*[F.array(F.floor(place(q)), F.ceil(place(q))) for q in shares.values()])))).alias("_r")
    now = ranges.select(*key, ranks, "_lo", "_hi", "_d", F.lit(0).cast("long").alias("_before"))
    while not now.filter(F.col("_d") > most).isEmpty():
        # halved first, so that the widest range doesn't overflow
        share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        wide = now.filter(F.col("_d") > most)
        bins = _inside(counted, wide, key).withColumn("_b", F.least(F.floor(share * bins_of), F.lit(bins_of - 1)))
        bins = bins.groupBy(*key, "_lo", "_hi", "_b").agg(F.sum("_k").alias("_m"), F.min("_v").alias("_l2"), F.max("_v").alias("_h2"), F.count("*").alias("_d2"))
        hit = _ranked(wide, bins, key, "_b")
        narrowed = hit.select(*[F.col(f"o.{c}").alias(c) for c in key], "o._r", F.col("b._l2").alias("_lo"), F.col("b._h2").alias("_hi"), F.col("b._d2").alias("_d"), (F.col("o._before") + F.col("b._past")).alias("_before"))
        now = written(now.filter(F.col("_d") <= most).unionByName(narrowed), "ranks")
    few = _inside(counted, now, key).withColumnRenamed("_k", "_m")
    done = _ranked(now, few, key, "_v").select(*[F.col(f"o.{c}").alias(c) for c in key], "o._r", "b._v")
    at = ranges.select(*key, "_n").alias("g").join(done.alias("d"), _same("g", "d", key)).select(*[F.col(f"g.{c}").alias(c) for c in key], "g._n", "d._r", "d._v")
    out = []
    for c in columns:
        for name, q in shares.items():
            p = place(q)
            low, high = (F.max(F.when((F.col("_c") == c) & (F.col("_r") == f(p)), F.col("_v"))) for f in (F.floor, F.ceil))
            part = F.max(F.when(F.col("_c") == c, p - F.floor(p)))
            v = F.when(part == 0, low).otherwise((1 - part) * low + part * high)
            out.append((F.round(v, digits) if digits is not None else v).alias(f"{c}_{name}"))
    if not by:
        return at.agg(*out)
    groups = rows.select(*by).distinct()
    t = at.groupBy(*by).agg(*out)
    return groups.alias("g").join(t.alias("t"), _same("g", "t", by), "left").select(*[F.col(f"g.{c}").alias(c) for c in by], *[f"t.{c}_{n}" for c in columns for n in shares])
