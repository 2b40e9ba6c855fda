"""Streams over the tables, run to their end and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.plans import bindings as b
from docquarry.plans import queries as batch_queries
from docquarry.sources.queue import post_once
from docquarry.sources.shared import shared_dir
from docquarry.streaming import stateful


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def _source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream.  A single file is picked out of its folder."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    for field in schema.fields:
        if field.dataType.simpleString() == "timestamp_ntz":
            stream = stream.withColumn(field.name, F.col(field.name).cast("timestamp"))
    return stream


def drained(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run ``stream`` until all input there is was read; what it wrote."""
    spark = stream.sparkSession
    folder = _folder(spark)
    if mode == "append":
        writer = stream.writeStream.format("parquet").option("path", f"{folder}/out")
    else:  # parquet takes appends only
        writer = stream.writeStream.outputMode(mode).foreachBatch(
            lambda batch, n: batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(f"{folder}/out")
        )
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, stateful.STORE)  # read when the stream starts, then as it was
    try:
        running = writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    finally:
        spark.conf.set(key, before)
    running.awaitTermination()
    schema = stream.schema if mode == "append" else stream.schema.add("batch", "long")
    return spark.read.schema(schema).parquet(f"{folder}/out")


def stream_scatter_gather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold as many distinct shards as they announce."""
    stream = _source(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("int").alias("shard_idx"), ((F.col("l_orderkey") % 4) + 1).cast("int").alias("shards_total")
    )
    told = drained(stateful.scatter_gather(stream.where("shard_idx <= shards_total")), "update")
    return told.groupBy("doc_id").agg(F.min_by("shards_done", "batch").alias("shards_done"))


def stream_state_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last state of each document."""
    stream = _source(spark, sf_dir, "events").selectExpr("user_id AS doc_id", "event_id AS seq", f"{b._REQUEST} AS to_state")
    out = drained(stateful.state_machine(stream), "update")
    return out.groupBy("doc_id").agg(*[F.max_by(c, "batch").alias(c) for c in ("state", "accepted", "rejected", "last_order")])


def stream_dedupe_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One posted row per document, ever."""
    stream = _source(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("id"))
    folder = _folder(spark)
    each = lambda batch, n: post_once(batch, f"{folder}/posted")
    stream.writeStream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).foreachBatch(each).start().awaitTermination()
    return spark.read.schema("doc_id long, id long").parquet(f"{folder}/posted").select("doc_id")


def stream_deadman_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily liveness; the last window stays open until later events come."""
    kind = F.when(F.col("event_type") == "purchase", "complete").when(F.col("event_type") == "signup", "ingest")
    stream = _source(spark, sf_dir, "events").select("ts", kind.alias("kind"))
    return drained(stateful.liveness_windows(stream)).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def stream_stuck_timer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose last known state is in flight and has been for long."""
    stream = _source(spark, sf_dir, "events").selectExpr("user_id AS doc_id", "event_id AS seq", f"{b._REQUEST} AS state", "ts")
    return drained(stateful.stuck_timer(stream))


QUERIES = {f.__name__: f for f in (stream_scatter_gather, stream_state_machine, stream_dedupe_sink, stream_deadman_window, stream_stuck_timer)}

SQL = {
    "stream_state_machine": batch_queries.SQL["transition_fold"],
    "stream_scatter_gather": """SELECT l_orderkey AS doc_id, count(DISTINCT l_linenumber)::BIGINT AS shards_done FROM lineitem WHERE l_linenumber <= l_orderkey % 4 + 1 GROUP BY 1 HAVING count(DISTINCT l_linenumber) = l_orderkey % 4 + 1""",
    "stream_dedupe_sink": "SELECT DISTINCT user_id AS doc_id FROM events WHERE event_type = 'purchase'",
    "stream_deadman_window": """WITH w AS (SELECT date_trunc('day', ts) AS window_start, count(*) FILTER (event_type = 'purchase')::BIGINT AS completed, count(*) FILTER (event_type = 'signup')::BIGINT AS ingested FROM events GROUP BY 1)
SELECT window_start, completed, ingested, completed > 0 OR ingested = 0 AS healthy FROM w WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
    "stream_stuck_timer": f"""WITH l AS (SELECT user_id AS doc_id, arg_max({b._REQUEST}, event_id) AS state, epoch_us(max(ts)) // 1000 AS at_ms FROM events GROUP BY 1)
SELECT doc_id, state, at_ms FROM l WHERE state IN ('text_pending', 'text_running', 'extract_pending', 'extract_running') AND at_ms + {stateful.StuckTimer.LIMIT_MS} <= (SELECT epoch_us(max(ts)) // 1000 - 3600000 FROM events)""",
}
