"""Recognition of page ranges, and the join of their outputs.

A message asks for one shard of a document.  Its pages go through a recognition
engine in Arrow batches; a map in the state store claims the shard, once however
often it is delivered; and the claim that completes a document tells so, once.
What a micro-batch makes of that (outputs, claims, messages) is committed by one
manifest, so a failure between the writes leaves nothing half done: the batch
comes again with the state as it was.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from docquarry.sources.batches import commit_batch
from docquarry.streaming.stateful import STORE

#: Images of a batch of pages to their texts and confidences.
Engine = Callable[[list[bytes]], list[tuple[str, float]]]

MESSAGE = "shard_idx int, shards_total int, page_start int, page_end int"
PAGES = "array<struct<page_no:int,text:string,confidence:double>>"
TABLES = {
    "outputs": f"doc_id long, shard_idx int, pages {PAGES}",
    "claims": "doc_id long, shard_idx int",
    "messages": "doc_id long, topic string, payload string",
}


def recognise(pages: DataFrame, engine: Engine) -> DataFrame:
    """``pages`` (``image`` and any other columns) with ``text`` and ``confidence``
    instead of ``image``.  The engine sees the images of a batch; one without
    an image (null) has an empty text."""
    kept = [c for c in pages.columns if c != "image"]
    schema = pages.select(*kept).schema.add("text", "string").add("confidence", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = engine([image if image is not None else b"" for image in batch.column(len(kept)).to_pylist()])
            texts, sure = zip(*told, strict=True) if told else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(sure, pa.float64())], [*kept, "text", "confidence"])

    return pages.select(*kept, "image").mapInArrow(run, schema)


class ShardClaims(StatefulProcessor):
    """Claims each shard of a document once and tells which claim was its last.  A
    finished document keeps a mark instead of its claims; where ``keep_ms`` is given
    (in processing time), what was not touched for so long is forgotten."""

    def __init__(self, keep_ms: int | None = None) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.claimed = handle.getMapState("claimed", "shard_idx int", "pages int", self.keep_ms)
        self.count = handle.getValueState("count", "done int, finished boolean", self.keep_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        pages = pd.concat(list(rows)).drop_duplicates(["shard_idx", "page_no"]).sort_values(["shard_idx", "page_no"])
        stored = self.count.get()
        (done, finished), out = (0, False) if stored is None else (int(stored[0]), bool(stored[1])), []
        for shard, own in pages.groupby("shard_idx"):
            if finished or self.claimed.containsKey((int(shard),)):
                continue
            read = [{"page_no": int(p), "text": t, "confidence": float(c)} for p, t, c in zip(own["page_no"], own["text"], own["confidence"], strict=True) if p >= 0]
            self.claimed.updateValue((int(shard),), (len(read),))
            done += 1
            finished = done == int(own["shards_total"].iloc[0])
            out.append((key[0], int(shard), json.dumps(read), finished))
        if out:
            self.count.update((done, finished))
            if finished:
                self.claimed.clear()
        yield pd.DataFrame(out, columns=["doc_id", "shard_idx", "output", "won"]).astype({"doc_id": "int64", "shard_idx": "int32", "output": "object", "won": "bool"})

    def close(self) -> None:
        pass


def shard_claims(messages: DataFrame, images: DataFrame, engine: Engine, keep_ms: int | None = None) -> DataFrame:
    """``doc_id``, ``shard_idx``, ``output`` (its pages as JSON) and ``won`` of each shard that
    is claimed for the first time.  ``messages`` is a stream of ``doc_id`` and
    MESSAGE; ``images`` has ``doc_id``, ``page_no`` and ``image``.  A shard without pages is
    claimed with none."""
    number = F.explode(F.when(F.col("page_end") > F.col("page_start"), F.sequence("page_start", F.col("page_end") - 1)).otherwise(F.array(F.lit(-1))))
    asked = messages.select("doc_id", "shard_idx", "shards_total", number.alias("page_no"))
    found = images.select(F.col("doc_id").alias("_doc"), F.col("page_no").alias("_page"), "image")
    joined = asked.join(found, (F.col("doc_id") == F.col("_doc")) & (F.col("page_no") == F.col("_page")), "left").drop("_doc", "_page")
    return recognise(joined, engine).groupBy("doc_id").transformWithStateInPandas(
        ShardClaims(keep_ms),
        outputStructType="doc_id long, shard_idx int, output string, won boolean",
        outputMode="Append",
        timeMode="None" if keep_ms is None else "ProcessingTime",
    )


def run_shards(messages: DataFrame, images: DataFrame, engine: Engine, root: str, checkpoint: str, keep_ms: int | None = None):
    """Start ``shard_claims`` into the batches below ``root``, whose tables are TABLES."""
    spark = messages.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = batch.persist()
        try:
            payload = F.to_json(F.struct(F.col("doc_id")))
            tables = {
                "outputs": rows.select("doc_id", "shard_idx", F.from_json("output", PAGES).alias("pages")),
                "claims": rows.select("doc_id", "shard_idx"),
                "messages": rows.where("won").select("doc_id", F.lit("ocr.completed").alias("topic"), payload.alias("payload")),
            }
            if not commit_batch(session, root, number, tables):
                # an earlier attempt was stopped behind its manifest; the state has yet to move on
                rows.write.format("noop").mode("overwrite").save()
        finally:
            rows.unpersist()

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, STORE)  # read when the stream starts, then as it was
    try:
        return shard_claims(messages, images, engine, keep_ms).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
    finally:
        spark.conf.set(key, before)
