"""State and messages of the state machine, written as one.

The messages that a change of state calls for are rows of the same batch as the
state itself, so neither is seen without the other, and the relay takes them
from committed batches only (``sources.batches.relay_batches``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.sources.batches import commit_batch, numbered, read_batches
from docquarry.streaming.stateful import STORE, state_machine

TABLES = {
    "state": "doc_id long, state string, accepted long, rejected long, last_order long, batch long",
    "messages": "doc_id long, topic string, payload string, batch long",
}

#: Who has to hear of a document that has come to a state.
TOPICS = {"text_pending": "triage.requests", "extract_pending": "ocr.completed", "complete": "document.extracted"}


def topic_of(state: Column) -> Column:
    told = F.lit(None).cast("string")
    for name, topic in TOPICS.items():
        told = F.when(state == name, topic).otherwise(told)
    return told


def run_transitions(requests: DataFrame, root: str, checkpoint: str):
    """Fold a stream of ``doc_id``, ``seq`` and ``to_state`` into the tables TABLES below
    ``root``: a row per document and micro-batch, and its message if there is one."""
    spark = requests.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        try:
            told = rows.withColumn("topic", topic_of(F.col("state"))).where("topic IS NOT NULL")
            messages = told.select("doc_id", "topic", F.to_json(F.struct("doc_id")).alias("payload"))
            if not commit_batch(batch.sparkSession, root, number, {"state": numbered(rows, number), "messages": numbered(messages, number)}):
                # an earlier attempt was stopped behind its manifest; the state has yet to move on
                rows.write.format("noop").mode("overwrite").save()
        finally:
            rows.unpersist()

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, STORE)  # read when the stream starts, then as it was
    try:
        return state_machine(requests).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
    finally:
        spark.conf.set(key, before)


def current(spark, root: str) -> DataFrame:
    """The last committed state of each document."""
    rows = read_batches(spark, root, "state", TABLES["state"])
    return rows.groupBy("doc_id").agg(*[F.max_by(c, "batch").alias(c) for c in ("state", "accepted", "rejected", "last_order")])
