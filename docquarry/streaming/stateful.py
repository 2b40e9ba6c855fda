"""Stateful operators keyed by document.

State lives in the state store (RocksDB), a key per document, so one task owns
a document at a time.  Within a micro-batch rows of a key are ordered by ``seq``
before they are applied; which delivery of a shard comes first across batches
is not determined, that exactly one completes the document is.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from docquarry.functions.states import IN_FLIGHT, TRANSITIONS

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ordered(rows: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    return pd.concat(list(rows)).sort_values(by)


class StateMachine(StatefulProcessor):
    """Applies guarded transitions; emits the state after each batch of a key."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "state string, accepted long, rejected long, last_order long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        stored = self.state.get()
        state, accepted, rejected, last = stored if stored is not None else ("text_pending", 0, 0, -1)
        for seq, target in _ordered(rows, ["seq"])[["seq", "to_state"]].itertuples(index=False):
            if target == state or target in TRANSITIONS.get(state, ()):
                state, accepted, last = target, accepted + 1, int(seq)
            else:
                rejected += 1
        self.state.update((state, accepted, rejected, last))
        yield pd.DataFrame({"doc_id": [key[0]], "state": [state], "accepted": [accepted], "rejected": [rejected], "last_order": [last]})

    def close(self) -> None:
        pass


class StuckTimer(StatefulProcessor):
    """Event-time timers: a document that is in flight and silent for longer
    than the limit is reported once, when the watermark passes."""

    LIMIT_MS = 6 * 3600 * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "state string, at long, seq long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        last = _ordered(rows, ["seq"]).iloc[-1]
        seq, at, state = int(last["seq"]), int(last["at_ms"]), str(last["state"])
        empty = pd.DataFrame({"doc_id": pd.Series([], dtype="int64"), "state": pd.Series([], dtype="object"), "at_ms": pd.Series([], dtype="int64")})
        stored = self.state.get()
        if stored is not None and stored[2] > seq:  # an older event in a later batch
            yield empty
            return
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.state.update((state, at, seq))
        if state in IN_FLIGHT:
            self.handle.registerTimer(at + self.LIMIT_MS)
        yield empty

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        state, at, _ = self.state.get()
        yield pd.DataFrame({"doc_id": [key[0]], "state": [state], "at_ms": [at]})

    def close(self) -> None:
        pass


def scatter_gather(stream: DataFrame) -> DataFrame:
    """``doc_id`` and ``shards_done`` of documents whose distinct shards reach their
    total, in update mode.  ``stream`` has ``doc_id``, ``shard_idx`` and
    ``shards_total``.

    The distinct shards are an aggregate in the state store, without Python.  A
    shard that is delivered again later tells its document again, so the sink
    keeps the first row of each."""
    counted = stream.groupBy("doc_id").agg(F.size(F.collect_set("shard_idx")).cast("long").alias("shards_done"), F.max("shards_total").alias("wanted"))
    return counted.where("shards_done = wanted").select("doc_id", "shards_done")


def state_machine(stream: DataFrame) -> DataFrame:
    """``stream`` has ``doc_id``, ``seq`` and ``to_state``."""
    return stream.groupBy("doc_id").transformWithStateInPandas(
        StateMachine(),
        outputStructType="doc_id long, state string, accepted long, rejected long, last_order long",
        outputMode="Update",
        timeMode="None",
    )


def stuck_timer(stream: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """``stream`` has ``doc_id``, ``seq``, ``state`` and the timestamp ``ts``."""
    timed = stream.withColumn("at_ms", F.unix_millis("ts")).withWatermark("ts", lateness)
    return timed.groupBy("doc_id").transformWithStateInPandas(
        StuckTimer(), outputStructType="doc_id long, state string, at_ms long", outputMode="Append", timeMode="EventTime"
    )


def first_of_each(stream: DataFrame, key: list[str], ts: str = "ts", lateness: str = "40 days") -> DataFrame:
    """Drops repeats of a key within the lateness, so state stays bounded."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(key)


def liveness_windows(stream: DataFrame, ts: str = "ts", width: str = "1 day", lateness: str = "1 hour") -> DataFrame:
    """Per window: completions, arrivals, and whether it is healthy."""
    counted = stream.withWatermark(ts, lateness).groupBy(F.window(ts, width).alias("w")).agg(
        F.count_if(F.col("kind") == "complete").alias("completed"), F.count_if(F.col("kind") == "ingest").alias("ingested")
    )
    return counted.select(F.col("w.start").alias("window_start"), "completed", "ingested", ((F.col("completed") > 0) | (F.col("ingested") == 0)).alias("healthy"))
