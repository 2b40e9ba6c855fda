"""Uploads as they are told of: from bytes to a row of the ledger and a message.

The objects that a micro-batch of messages names are read, inspected and judged; one
that has vanished leaves no row, nor does one whose content was taken in before,
in this batch or an earlier one.  The rows of the others and the messages that
send them on are committed as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.functions import text
from docquarry.functions.crc32c import identity
from docquarry.operators.recon import text_topic
from docquarry.plans.triage import PAGE_CEILING, triage
from docquarry.sources.batches import commit_batch, read_batches
from docquarry.sources.blobs import read_blobs
from docquarry.sources.inspect import inspect

TABLES = {
    "documents": "gcs_path string, object_id string, content_id string, content_type string, page_count int, has_text_layer boolean, doc_type string, result string, state string, last_error string",
    "messages": "object_id string, topic string, payload string",
}


def taken_in(files: DataFrame, known: DataFrame, page_ceiling: int = PAGE_CEILING, shard_size: int = 1) -> DataFrame:
    """The rows of the ledger that ``files`` (``path``, ``content``, null if it vanished, and its
    ``checksum``, as ``read_blobs`` tells it) make, with ``topic`` of those that are sent on.  ``known`` has the ``content_id`` of
    what was taken in before; of equal contents the least path counts.  Rejected
    uploads have a row each."""
    facts = files.where("content IS NOT NULL").select(
        F.col("path").alias("doc_id"), F.col("path").alias("gcs_path"), F.length("content").cast("long").alias("size"),
        F.sha2("content", 256).alias("content_id"), identity(F.col("checksum")).alias("object_id"), "content",
    )
    # what a sample tells is told before rows meet their copies, so that no text is sent there
    seen = inspect(facts).withColumns({"has_text_layer": text.has_text_layer(F.col("sample")), "doc_type": text.doc_type(F.col("sample"))}).drop("sample")
    judged = triage(seen, page_ceiling)
    earlier = known.select(F.col("content_id").alias("_known")).distinct()
    fresh = judged.where("result <> 'duplicate'").join(earlier, (F.col("result") == "dispatched") & (F.col("content_id") == F.col("_known")), "left_anti")
    topic = F.when(F.col("result") == "dispatched", text_topic(F.col("has_text_layer"), F.col("page_count"), shard_size))
    running = F.col("result") == "dispatched"
    return fresh.select(
        "gcs_path", "object_id", "content_id", "content_type", "page_count", F.when(running, F.col("has_text_layer")).alias("has_text_layer"),
        F.when(running, F.col("doc_type")).alias("doc_type"), "result", "state", "last_error", topic.alias("topic"),
    )


def run_intake(told: DataFrame, objects: str, root: str, checkpoint: str, page_ceiling: int = PAGE_CEILING, shard_size: int = 1):
    """Start ``taken_in`` over a stream that names objects (``path``, below ``objects``) into the
    tables TABLES below ``root``.  A name that is told twice is read once in a batch; a
    batch that comes again is passed over if it was committed, and else finds the
    same known contents."""

    def each(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        known = read_batches(session, root, "documents", TABLES["documents"]).where("result = 'dispatched'")
        # by a given number: names are small, and Spark would leave all of them, and so all objects, to a task or two
        tasks = max(session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
        files = read_blobs(batch.select("path").repartition(tasks, "path").distinct(), objects)
        rows = taken_in(files, known, page_ceiling, shard_size).persist()
        try:
            single = F.col("topic") == "ocr.shard"
            payload = F.to_json(F.struct("object_id", "gcs_path", "page_count", F.when(single, 0).alias("shard_idx"), F.when(single, 1).alias("shards_total")))
            messages = rows.where("topic IS NOT NULL").select("object_id", "topic", payload.alias("payload"))
            commit_batch(session, root, number, {"documents": rows.drop("topic"), "messages": messages})
        finally:
            rows.unpersist()

    return told.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
