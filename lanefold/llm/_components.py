"""Connected components of an edge table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanefold.llm._common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root (the smallest node that it reaches) of every node in ``edges``.

    Alternates large-star and small-star steps: in each, a node's larger (smaller) neighbours are
    linked to its smallest one instead. Neighbourhoods are never gathered: the smallest neighbour is a
    partial aggregate, and joining it back to the edges is a join that adaptive execution can split.
    Each round is written in the shared folder, which cuts the lineage. The rounds grow with the
    logarithm of the longest chain. Nulls and self-links are ignored; an empty table gives an empty one.
    """
    now = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), "edges")
    state = None
    while True:
        # Large star: link every larger neighbour of u to the smallest of u and its neighbours.
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: link the smaller neighbours of u, and u, to the smallest of them.
        large = written(large.filter("u > v").distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        now = written(small.filter("u > v").distinct(), "edges")
        told = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(told) == state:
            break
        state = tuple(told)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
