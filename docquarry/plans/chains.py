"""The shard chain over the tables: messages on the file queue, delivered again
for some, recognised, claimed and joined on a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.operators import shards
from docquarry.plans import bindings as b
from docquarry.plans.queries import _FOLD_SQL, query
from docquarry.sources.batches import read_batches
from docquarry.sources.queue import publish, subscribe
from docquarry.sources.shared import shared_dir
from docquarry.streaming import outbox, shardchain

SIZE = 2


def plain_text(images: list[bytes]) -> list[tuple[str, float]]:
    """An engine for images that are their text."""
    return [(image.decode(), 0.85) for image in images]


def shard_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message per shard of each conversation; every third one's are delivered
    twice, and one in seven lacks its last."""
    docs = b.pages(spark, sf_dir).groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("pages"))
    asked = shards.split(docs, "pages", SIZE).where("doc_id % 7 <> 3 OR shard_idx < shards_total - 1")
    told = asked.withColumn("delivery", F.explode(F.when(F.col("doc_id") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    place = F.xxhash64("doc_id", "shard_idx", "delivery")
    payload = F.to_json(F.struct("shard_idx", "shards_total", "page_start", "page_end"))
    return told.select(place.alias("id"), F.col("doc_id").cast("string").alias("doc_id"), F.concat(F.lit("ocr.shard-"), F.pmod(place, F.lit(3))).alias("topic"), payload.alias("payload"), F.lit("2024-01-01").cast("timestamp").alias("created_at"))


@query(
    f"""WITH p AS (SELECT conv_id AS doc_id, turn, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS page_no FROM conversations)
SELECT doc_id, CAST(ceil(count(*) / {SIZE}) AS BIGINT) AS shards_done, count(*)::BIGINT AS n_pages, md5(string_agg(text, chr(10) ORDER BY page_no)) AS text_md5
FROM p WHERE doc_id % 7 <> 3 GROUP BY 1"""
)
def ocr_shard_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose every shard was recognised, told once, with their whole text."""
    folder = f"{shared_dir(spark)}/chain-{uuid.uuid4().hex}"
    publish(shard_messages(spark, sf_dir), f"{folder}/queue")
    queue = subscribe(spark, f"{folder}/queue", files_per_batch=2)
    asked = queue.select(F.col("doc_id").cast("long").alias("doc_id"), F.from_json("payload", shardchain.MESSAGE).alias("m")).select("doc_id", "m.*")
    images = b.pages(spark, sf_dir).select("doc_id", "page_no", F.coalesce("text", F.lit("")).cast("binary").alias("image"))
    shardchain.run_shards(asked, images, plain_text, f"{folder}/tables", f"{folder}/checkpoint").awaitTermination()
    read = lambda name: read_batches(spark, f"{folder}/tables", name, shardchain.TABLES[name])
    pages = read("outputs").select("doc_id", F.explode("pages").alias("p")).select("doc_id", "p.*")
    texts = shards.assemble(pages, "doc_id", "page_no", "text")
    done = read("claims").groupBy("doc_id").agg(F.count(F.lit(1)).alias("shards_done"))
    told = read("messages").where("topic = 'ocr.completed'").select("doc_id")
    return told.join(done, "doc_id").join(texts, "doc_id").select("doc_id", "shards_done", "n_pages", F.md5("source_text").alias("text_md5"))


@query(
    f"""{_FOLD_SQL}, last AS (SELECT doc_id, arg_max(state, n) AS state, max(last_order) AS last_order FROM f GROUP BY 1)
SELECT doc_id, state, last_order, CASE state WHEN 'text_pending' THEN 'triage.requests' WHEN 'extract_pending' THEN 'ocr.completed' WHEN 'complete' THEN 'document.extracted' END AS topic FROM last"""
)
def state_with_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of each document and the message that was committed with it."""
    folder = f"{shared_dir(spark)}/outbox-{uuid.uuid4().hex}"
    b.requests(spark, sf_dir).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("doc_id long, seq long, to_state string").parquet(f"{folder}/in")
    outbox.run_transitions(stream, f"{folder}/tables", f"{folder}/checkpoint").awaitTermination()
    sent = read_batches(spark, f"{folder}/tables", "messages", outbox.TABLES["messages"])
    last = sent.groupBy("doc_id").agg(F.max_by("topic", "batch").alias("topic"))
    return outbox.current(spark, f"{folder}/tables").join(last, "doc_id", "left").select("doc_id", "state", "last_order", "topic")
