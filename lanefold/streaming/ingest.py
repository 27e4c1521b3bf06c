"""Streams of records that land as files: incremental ingest, continuous upsert and completeness."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StringType, StructField, StructType

from lanefold.operators.store import upsert


def read_landing(spark: SparkSession, folder: str, schema, fmt: str = "parquet", files_per_batch: int = 100) -> DataFrame:
    """Rows of files as they land in ``folder``."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(folder)


def latest_by_key(batch: DataFrame, keys: list[str], version: str) -> DataFrame:
    """One row a key: the highest ``version``; a partial aggregate, so a busy key doesn't crowd one task."""
    rest = [c for c in batch.columns if c not in keys]
    best = batch.groupBy(*keys).agg(F.max(F.struct(version, *[c for c in rest if c != version])).alias("x"))
    return best.select(*keys, *[F.col(f"x.{c}") for c in rest])


class BucketStore:
    """A table in ``buckets`` parts by a hash of its keys, of which a batch writes only those that it touches.

    Batch n writes its parts to ``v=n`` and then lists them in ``parts``; a part's rows are those of the last batch that
    lists it. A batch that was cut off isn't listed, and one that is run again starts from what was before it, so it
    leaves the same rows. The driver sees one row a part and batch. Null keys match nothing, so their rows are added.
    Earlier versions stay until the folder is removed.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], buckets: int = 64):
        self.spark, self.root, self.keys, self.buckets = spark, root.rstrip("/"), keys, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def write(self, rows: DataFrame, n: int, parts: list[int] | None = None) -> None:
        """Stores ``rows`` as what batch n left in ``parts`` (the rows' own parts if not given)."""
        parts = self.touched(rows) if parts is None else parts
        t = rows.withColumn("_b", self.bucket())
        t.repartition(min(len(parts), self.buckets) or 1, "_b").write.mode("overwrite").partitionBy("_b").parquet(f"{self.root}/data/v={n}")
        self.spark.createDataFrame([(n, b) for b in parts], "n long, b int").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/parts/v={n}")

    def table(self, before: int | None = None, parts: list[int] | None = None) -> DataFrame | None:
        """The rows as of before batch ``before`` (all batches if not given), of ``parts`` or all; None if there is nothing."""
        listed = self.spark.read.schema("n long, b int").parquet(f"{self.root}/parts/*")
        known = listed if before is None else listed.filter(F.col("n") < before)
        last = known.groupBy("b").agg(F.max("n").alias("n")).collect()
        paths = [f"{self.root}/data/v={r.n}/_b={r.b}" for r in last if parts is None or r.b in parts]
        return self.spark.read.parquet(*sorted(paths)) if paths else None

    def upsert(self, new: DataFrame, n: int, supplied: list[str]) -> None:
        """Applies batch n: one row a key in ``new``; supplied columns are replaced, also by null."""
        parts = self.touched(new)
        if parts:
            stored = self.table(n, parts)
            first = new.select(*self.keys, *supplied)
            self.write(first if stored is None else upsert(stored, first, self.keys, supplied), n, parts)


def continuous_upsert(stream: DataFrame, store: BucketStore, supplied: list[str], version: str, checkpoint: str) -> StreamingQuery:
    """Applies every micro-batch to the store: the highest ``version`` of each key in the batch wins, later batches over earlier ones."""

    def apply(batch: DataFrame, n: int) -> None:
        new = latest_by_key(batch, store.keys, version).persist()
        try:
            store.upsert(new, n, supplied)
        finally:
            new.unpersist()

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def completions(landed: DataFrame, key: str, kind: str, wanted: list[str], time: str | None = None, timeout_s: int | None = None) -> DataFrame:
    """A stream of the samples whose last input lands: key, state and missing (kinds, comma-joined).

    ``landed`` is a stream with a row an input. A sample is told once as ``complete``, in the micro-batch in which its last
    wanted kind arrives; inputs that come again change nothing. With ``timeout_s`` a sample that isn't complete so many
    seconds of event time (column ``time``, with a watermark) after its first input is told as ``expired``, with what it lacks, and as
    ``late`` if it completes afterwards. What has arrived is kept as state by key, so a batch costs what lands in it, and
    a query that starts again from its checkpoint tells nothing twice. Rows with a null key or another kind are ignored.
    """
    if timeout_s is not None and time is None:
        raise ValueError("a timeout needs a time column")
    order = sorted(set(wanted))
    full = (1 << len(order)) - 1
    out_kind = landed.schema[key].dataType

    def step(keys: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        have, told, due = state.get if state.exists else (0, "", None)
        says = None
        if state.hasTimedOut:
            says = told = "expired"
        else:
            first = None
            for chunk in chunks:
                for name in chunk[kind].unique():
                    have |= 1 << order.index(name)
                if timeout_s is not None:
                    least = chunk[time].min()
                    first = least if first is None or least < first else first
            if have == full and told != "complete":
                says, told = "late" if told else "complete", "complete"
            if timeout_s is not None and due is None and not pd.isna(first):
                due = (int(first.timestamp()) + timeout_s) * 1000
        state.update((have, told, due))
        if told == "" and due is not None:
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))
        if says:
            missing = ",".join(k for i, k in enumerate(order) if not have >> i & 1)
            yield pd.DataFrame({key: [keys[0]], "state": [says], "missing": [missing]})

    schema = StructType([StructField(key, out_kind), StructField("state", StringType()), StructField("missing", StringType())])
    rows = landed.filter(F.col(kind).isin(order) & F.col(key).isNotNull()).select(key, kind, *([time] if time else []))
    return rows.groupBy(key).applyInPandasWithState(step, schema, "have long, told string, due long", "append", GroupStateTimeout.EventTimeTimeout if timeout_s is not None else GroupStateTimeout.NoTimeout)


def complete_samples(landed: DataFrame, key: str, kind: str, wanted: list[str]) -> DataFrame:
    """Keys of which every wanted kind of input has arrived."""
    seen = landed.filter(F.col(kind).isin(wanted)).groupBy(key).agg(F.countDistinct(kind).alias("n"))
    return seen.filter(F.col("n") == len(wanted)).select(key)
