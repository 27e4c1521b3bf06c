"""The folder that driver and executors share, for what a job writes on its way."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Where that is unset a local temporary folder stands in on a local master (tests on one machine); on a cluster, whose
    machines wouldn't see it, this raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.path.join(tempfile.gettempdir(), "lanefold-shared")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: cuts lineage, survives lost executors.

    The folder is the job's own scratch; whoever names ``spark.checkpoint.dir`` clears it after the job, since results
    may still be read from it lazily.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
