"""A message queue on files: topics are folders, rows are messages.

Delivery is at least once: a stream's offsets move on only after its batch is
through, and sinks are idempotent.  ``docqueue`` is the same as a Spark data source.
Where Spark has a broker's connector, the experimental ``broker_stream`` and
``broker_deliver`` stand in for the files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.operators.ledger import insert_if_absent
from docquarry.sources.objects import ensure_folder, exists

MESSAGE = "id long, doc_id string, topic string, payload string, created_at timestamp"


def ensure_topics(spark: SparkSession, root: str, topics: list[str]) -> None:
    for topic in topics:
        ensure_folder(spark, f"{root}/topic={topic}")


def publish(messages: DataFrame, root: str) -> None:
    """Append messages; a folder per topic, rows of a document together."""
    messages.repartition("topic", "doc_id").sortWithinPartitions("topic", "id").write.mode("append").partitionBy("topic").parquet(root)


def subscribe(spark: SparkSession, root: str, topics: list[str] | None = None, files_per_batch: int = 1000) -> DataFrame:
    stream = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", files_per_batch).parquet(root)
    return stream.where(F.col("topic").isin(*topics)) if topics else stream


def broker_stream(spark: SparkSession, servers: str, topics: list[str], per_batch: int = 100_000) -> DataFrame:
    """Experimental, never run here: the same messages from a broker, where Spark has
    its connector.  The place of
    a message in its topic is its id; its key is the document."""
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics))
    found = stream.option("startingOffsets", "earliest").option("maxOffsetsPerTrigger", per_batch).load()
    place = F.shiftleft(F.col("partition").cast("long"), 48) + F.col("offset")
    return found.select(
        place.alias("id"), F.col("key").cast("string").cast("long").alias("doc_id"), "topic", F.col("value").cast("string").alias("payload"), F.col("timestamp").alias("created_at")
    )


def broker_deliver(servers: str) -> Callable[[DataFrame, int], int]:
    """Experimental, never run here: what ``relay`` hands batches to; they are written
    to the broker or raise."""

    def deliver(batch: DataFrame, number: int) -> int:
        told = batch.select("topic", F.col("doc_id").cast("string").alias("key"), F.col("payload").alias("value"))
        told.write.format("kafka").option("kafka.bootstrap.servers", servers).option("kafka.acks", "all").save()
        return batch.count()

    return deliver


def decoded(messages: DataFrame, schema: str) -> DataFrame:
    """Payloads parsed; a message that is no such JSON gives null fields."""
    return messages.select("id", "doc_id", "topic", F.from_json("payload", schema).alias("body"))


class DeliveryError(RuntimeError):
    """Some messages of a batch were not delivered."""


def relay(stream: DataFrame, deliver: Callable[[DataFrame, int], int], checkpoint: str):
    """Hand each batch to ``deliver``, which returns how many it delivered.
    Fewer than all fails the batch; its offsets stay, and it comes again."""

    def each(batch: DataFrame, number: int) -> None:
        wanted, done = batch.count(), deliver(batch, number)
        if done < wanted:
            raise DeliveryError(f"{wanted - done} of {wanted} messages were not delivered")

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()


def post_once(rows: DataFrame, folder: str, key: str = "doc_id", order: str = "id") -> None:
    """Append the rows whose key was never posted; of several the first."""
    spark = rows.sparkSession
    posted = spark.read.parquet(folder) if exists(spark, folder) else spark.createDataFrame([], rows.schema)
    insert_if_absent(rows, posted, [key], [F.col(order)]).write.mode("append").parquet(folder)
