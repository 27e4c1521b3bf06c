"""Sources outside files of reports: curated tables and job accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns of the accounting rows, in their order.
ACCOUNTING = (
    "JobID", "Account", "State", "ExitCode", "Partition", "ReqCPUS", "AllocCPUS", "TotalCPU", "ReqMem", "AllocTRES", "Timelimit", "Elapsed", "NNodes", "AveRSS", "NTasks",
    "CPUtime", "CPUTimeRAW", "Submit", "Start", "End",
)


def read_curated(spark: SparkSession, source: str, table: str, split_by: str | None = None, parts: int = 16, **options: str) -> DataFrame:
    """A curated table: over JDBC where ``source`` is a jdbc: address, else Parquet at ``source/table.parquet``.

    ``split_by``, a whole-number column, reads a JDBC table in ``parts`` ranges between its least and largest value.
    """
    if not source.startswith("jdbc:"):
        return spark.read.parquet(f"{source.rstrip('/')}/{table}.parquet")
    reader = spark.read.format("jdbc").options(url=source, dbtable=table, **options)
    if split_by:
        ends = spark.read.format("jdbc").options(url=source, query=f"SELECT min({split_by}) AS a, max({split_by}) AS b FROM {table}", **options).load().first()
        if ends["a"] is not None:
            reader = reader.options(partitionColumn=split_by, lowerBound=str(ends["a"]), upperBound=str(ends["b"] + 1), numPartitions=str(parts))
    return reader.load()


def job_accounting(lines: DataFrame, value: str = "value") -> DataFrame:
    """The accounting columns of bar-separated lines, with job_id and is_parent (the row of the job itself, not of a step).

    Empty fields are null, blank lines are left out; Submit, Start and End are ``N/A`` where unknown and have a blank for
    the T otherwise. Lines with fewer fields have nulls behind.
    """
    parts = F.split(value, r"\|", -1)
    t = lines.filter(F.trim(value) != "").select(*[F.nullif(F.get(parts, F.lit(k)), F.lit("")).alias(c) for k, c in enumerate(ACCOUNTING)])
    times = {c: F.when(F.col(c).isNull() | F.col(c).isin("Unknown", "N/A", "None", "0"), "N/A").otherwise(F.replace(c, F.lit("T"), F.lit(" "))) for c in ACCOUNTING[-3:]}
    return t.withColumns({**times, "job_id": F.split("JobID", r"\.")[0], "is_parent": ~F.col("JobID").contains(".")})
