"""Queries that run a stream over the landed tables to its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from lanefold.plans.registry import query
from lanefold.plans.scratch import scratch
from lanefold.streaming import ingest


def _events(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return ingest.read_landing(spark, f"{sf_dir}/events.parquet*", schema)


@query("SELECT event_id, user_id, event_type, value FROM events")
def st1_incremental_ingest(spark, sf_dir):
    out = scratch(spark, "landed")
    rows = _events(spark, sf_dir).select("event_id", "user_id", "event_type", "value")
    rows.writeStream.format("parquet").option("checkpointLocation", f"{out}-log").trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out)


@query("""WITH last AS (SELECT user_id, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY user_id)
SELECT c_custkey AS user_id, l.event_id, CASE WHEN l.user_id IS NULL THEN c_acctbal ELSE l.value END AS value FROM customer c LEFT JOIN last l ON l.user_id = c_custkey
UNION ALL SELECT user_id, event_id, value FROM last WHERE user_id NOT IN (SELECT c_custkey FROM customer)""")
def st2_continuous_upsert(spark, sf_dir):
    out = scratch(spark, "store")
    start = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("user_id"), F.lit(None).cast("long").alias("event_id"), F.col("c_acctbal").alias("value"))
    store = ingest.BucketStore(spark, out, ["user_id"])
    store.write(start, -1)
    stream = _events(spark, sf_dir).select("user_id", "event_id", "value")
    ingest.continuous_upsert(stream, store, ["event_id", "value"], "event_id", f"{out}-log").awaitTermination()
    return store.table()


@query("SELECT user_id FROM (SELECT user_id, count(DISTINCT event_type) AS n FROM events WHERE event_type IN ('error', 'click') GROUP BY user_id) x WHERE n = 2")
def st3_complete_samples(spark, sf_dir):
    out = scratch(spark, "complete")
    found = ingest.completions(_events(spark, sf_dir), "user_id", "event_type", ["error", "click"]).select("user_id")
    found.writeStream.format("parquet").option("checkpointLocation", f"{out}-log").trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out)


@query("SELECT user_id FROM (SELECT user_id, count(DISTINCT event_type) AS n FROM events WHERE event_type IN ('error', 'click') GROUP BY user_id) x WHERE n = 2")
def st3_complete_of_landed(spark, sf_dir):
    return ingest.complete_samples(st1_incremental_ingest(spark, sf_dir), "user_id", "event_type", ["error", "click"])
