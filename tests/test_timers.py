"""Wall-clock timers, with a clock of our own and then with the real one."""

import time

import pandas as pd
from pyspark.sql import functions as F

from docquarry.streaming.stateful import STORE
from docquarry.streaming.timers import StageTimer, silent_documents


class Value:
    """A value state; ``ttl`` counts from the last update, by the clock."""

    def __init__(self, clock, ttl):
        self.clock, self.ttl, self.value, self.at = clock, ttl, None, 0

    def get(self):
        if self.value is not None and self.ttl is not None and self.clock[0] >= self.at + self.ttl:
            self.value = None
        return self.value

    def update(self, value):
        self.value, self.at = value, self.clock[0]

    def clear(self):
        self.value = None


class Document:
    """One key of the processor, its states and timers, and a clock that is set."""

    def __init__(self, **limits):
        self.clock, self.timers, self.states = [0], set(), {}
        self.processor = StageTimer(**limits)
        self.processor.init(self)

    def getValueState(self, name, schema, ttl=None):
        return self.states.setdefault(name, Value(self.clock, ttl))

    def listTimers(self):
        return iter(sorted(self.timers))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def getCurrentProcessingTimeInMs(self):
        return self.clock[0]

    def word(self, *rows):
        list(self.processor.handleInputRows((1,), iter([pd.DataFrame(rows, columns=["seq", "state"])]), self))

    def at(self, now):
        """Moves on to ``now``; what the timers that ran out on the way reported."""
        out = []
        while self.timers and min(self.timers) <= now:
            self.clock[0] = min(self.timers)
            self.timers.discard(self.clock[0])
            for frame in self.processor.handleExpiredTimer((1,), self, None):
                out += [tuple(r)[1:] for r in frame.itertuples(index=False)]
        self.clock[0] = now
        return out

    def kept(self):
        return {n for n, s in self.states.items() if s.get() is not None}


def test_stages_have_their_own_limits():
    d = Document(text_ms=100, extract_ms=1000)
    d.word((1, "text_running"))
    assert d.at(99) == [] and d.at(350) == [("text_running", 100, 1), ("text_running", 200, 2), ("text_running", 300, 3)]
    d.word((2, "extract_pending"), (3, "extract_running"))
    assert d.at(1349) == [] and d.at(1350) == [("extract_running", 1000, 1)]


def test_word_starts_the_time_anew_and_old_word_does_not():
    d = Document(text_ms=100)
    d.word((5, "text_running"))
    d.at(90)
    d.word((6, "text_running"))
    assert d.at(180) == []
    d.word((4, "complete"))  # older than what is known
    assert d.at(190) == [("text_running", 100, 1)]


def test_finished_documents_leave_the_store():
    d = Document(text_ms=100, known_ms=500)
    d.word((1, "text_running"))
    d.word((9, "complete"))
    assert d.kept() == {"done"} and not d.timers
    d.word((2, "text_running"))  # late and older
    assert d.kept() == {"done"} and d.at(499) == [] and d.at(500) == [] and d.kept() == set()
    d.word((12, "review"))
    d.word((13, "extract_pending"))  # taken up again
    assert d.kept() == {"open"} and len(d.timers) == 1


def test_the_same_on_a_stream(spark, tmp_path):
    schema = "doc_id long, seq long, state string"
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    write([(1, 1, "text_running"), (2, 1, "text_running"), (3, 1, "extract_running"), (4, 1, "complete")])
    reports = silent_documents(spark.readStream.schema(schema).parquet(source), text_ms=1500, extract_ms=600_000, known_ms=2000)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, STORE)
    try:
        query = (
            reports.writeStream.outputMode("update").option("checkpointLocation", f"file://{tmp_path}/checkpoint").trigger(processingTime="1 second")
            .foreachBatch(lambda batch, n: batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(out)).start()
        )
    finally:
        spark.conf.set(key, before)
    try:
        told, until = {}, time.time() + 90
        while time.time() < until and not ({1, 2} <= set(told)):
            time.sleep(1)
            if (tmp_path / "out").exists():
                rows = spark.read.schema("doc_id long, state string, waited_ms long, reports int, batch int").parquet(out).collect()
                told = {r["doc_id"]: max(r["waited_ms"], told.get(r["doc_id"], 0)) for r in rows}
        assert set(told) == {1, 2} and min(told.values()) >= 1500
        write([(1, 2, "complete"), (2, 2, "failed"), (3, 2, "review")])
        until = time.time() + 60
        while time.time() < until and not (query.lastProgress and query.lastProgress["stateOperators"][0]["numRowsTotal"] == 0):
            time.sleep(1)
        # nothing is open, and what was finished is forgotten after its time
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 0, query.lastProgress["stateOperators"][0]
    finally:
        query.stop()
