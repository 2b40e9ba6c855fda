"""The queue as a data source: offsets, restarts, replays and commits in two phases."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from docquarry.sources import batches, docqueue
from docquarry.sources.queue import publish, subscribe
from tests.test_sources import messages

SCHEMA = "id long, doc_id string, topic string, payload string, created_at timestamp"


@pytest.fixture
def queue(spark):
    docqueue.register(spark)
    return spark


def stream(spark, root, group="default"):
    return spark.readStream.format("docqueue").option("path", root).option("group", group).load()


def sent(frame, root, checkpoint):
    """Run a stream to its end into the queue."""
    frame.writeStream.format("docqueue").option("path", root).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def taken(frame, checkpoint, deliver):
    running = frame.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(deliver).start()
    running.awaitTermination()


def test_a_stream_through_the_queue_has_the_rows_of_the_file_queue(queue, tmp_path):
    plain, root = f"file://{tmp_path}/plain", f"file://{tmp_path}/queue"
    got = []
    for ids in (range(20), range(20, 30), []):
        publish(messages(queue, ids) if ids else messages(queue, [0]).limit(0), plain)
        sent(subscribe(queue, plain), root, f"file://{tmp_path}/sink")
        taken(stream(queue, root), f"file://{tmp_path}/reader", lambda batch, n: got.extend(tuple(r) for r in batch.collect()))
    want = sorted(tuple(r[c] for c in ("id", "doc_id", "topic", "payload", "created_at")) for r in queue.read.schema(SCHEMA).parquet(plain).collect())
    assert sorted(got) == want and len(want) == 30
    # the batch reader, and the readers of batches, see the same
    assert sorted(tuple(r) for r in queue.read.format("docqueue").option("path", root).load().collect()) == want
    assert sorted(tuple(r) for r in batches.read_batches(queue, root, "messages", SCHEMA).collect()) == want
    # Spark tells a source that a batch is through when it plans the next
    assert json.loads((tmp_path / "queue" / "groups" / "default.json").read_text())["next"] == max(docqueue.Store(root).batches())


def test_batches_of_other_writers_are_read(queue, tmp_path):
    root, got = f"file://{tmp_path}/queue", []
    batches.commit_batch(queue, root, 3, {"messages": messages(queue, range(4)), "state": queue.range(2)})
    batches.commit_batch(queue, root, 7, {"state": queue.range(2)})
    taken(stream(queue, root), f"file://{tmp_path}/reader", lambda batch, n: got.extend(r["id"] for r in batch.collect()))
    assert sorted(got) == [0, 1, 2, 3]
    states = queue.read.format("docqueue").option("path", root).option("table", "state").schema("id long").load()
    assert sorted(r["id"] for r in states.collect()) == [0, 0, 1, 1]


def test_a_failed_batch_is_replayed_and_a_restart_goes_on(queue, tmp_path):
    root, got = f"file://{tmp_path}/queue", []
    batches.commit_batch(queue, root, 0, {"messages": messages(queue, range(5))})

    def fail(batch, number):
        raise RuntimeError("the consumer is lost")

    with pytest.raises(Exception, match="lost"):
        taken(stream(queue, root), f"file://{tmp_path}/reader", fail)
    keep = lambda batch, n: got.extend(r["id"] for r in batch.collect())
    taken(stream(queue, root), f"file://{tmp_path}/reader", keep)
    assert sorted(got) == list(range(5))
    batches.commit_batch(queue, root, 1, {"messages": messages(queue, range(5, 8))})
    taken(stream(queue, root), f"file://{tmp_path}/reader", keep)
    assert sorted(got) == list(range(8))
    other = []
    taken(stream(queue, root, "second"), f"file://{tmp_path}/second", lambda batch, n: other.extend(r["id"] for r in batch.collect()))
    assert sorted(other) == list(range(8))


def test_a_sink_that_fails_in_a_task_or_before_its_commit_log_writes_once(queue, tmp_path):
    plain, root, sink = f"file://{tmp_path}/plain", f"file://{tmp_path}/queue", f"file://{tmp_path}/sink"
    publish(messages(queue, range(12)), plain)
    broken = subscribe(queue, plain).withColumn("payload", F.when(F.col("id") == 7, F.raise_error(F.lit("task lost"))).otherwise(F.col("payload")))
    with pytest.raises(Exception, match="task lost"):
        sent(broken, root, sink)
    assert docqueue.Store(root).batches() == []
    sent(subscribe(queue, plain), root, sink)
    read = lambda: sorted(r["id"] for r in queue.read.format("docqueue").option("path", root).load().collect())
    assert read() == list(range(12))
    files = len(docqueue.Store(root).names("messages"))
    # stopped between the manifest and the stream's own log: the batch comes again
    shutil.rmtree(tmp_path / "sink" / "commits")
    sent(subscribe(queue, plain), root, sink)
    assert read() == list(range(12)) and len(docqueue.Store(root).names("messages")) == files
    assert docqueue.Store(root).batches() == [0]


def test_of_two_commits_of_a_number_the_first_counts(tmp_path):
    store = docqueue.Store(f"file://{tmp_path}")
    writer = docqueue.StreamWriter(f"file://{tmp_path}", "messages", None)
    store.write("messages/a.parquet", b"x")
    store.write("messages/b.parquet", b"y")
    writer.commit([docqueue.Written(["messages/a.parquet"]), None], 4)
    writer.commit([docqueue.Written(["messages/b.parquet"])], 4)
    assert store.files("messages", 0, 9) == ["messages/a.parquet"] and store.names("messages") == ["a.parquet"]
    assert store.files("messages", 5, 9) == [] and docqueue.Store(f"file://{tmp_path}/none").batches() == []
