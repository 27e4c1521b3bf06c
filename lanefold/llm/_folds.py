"""Folds by document identifier and bounded, seeded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id: str = "doc_id") -> Column:
    """Whether crc32 of the identifier as text is divisible by 5; a null identifier isn't held out, nor learned from."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(rows: DataFrame, label: str, per_label: int, id: str = "doc_id") -> DataFrame:
    """About ``per_label`` rows of each label outside the held-out fold, chosen by a hash of the identifier.

    Labels with fewer rows give all, however many labels there are. Only identifiers and labels are counted; the bound is
    on rows. The counts are broadcast, as joins by label would shuffle texts; callers collect more than a row a label anyway.
    """
    rows = rows.filter(F.col(label).isNotNull() & F.col(id).isNotNull() & ~held_out(id))
    n = rows.groupBy(F.col(label).alias("_l")).agg(F.count("*").alias("_n"))
    share = F.pmod(F.xxhash64(F.lit(5), F.col(id)), F.lit(1 << 30)) / float(1 << 30)
    return rows.join(F.broadcast(n), F.col(label) == F.col("_l")).filter(share * F.col("_n") < per_label).drop("_l", "_n")
