"""Batches of several tables: all or nothing, once, and the shard chain on top."""

import pytest
from pyspark.sql import functions as F

from docquarry.sources import batches, objects
from docquarry.sources.queue import publish, subscribe
from docquarry.streaming import outbox, shardchain

STATE, MESSAGES = "doc_id long, state string", "id long, doc_id long, topic string"


def rows(spark, ids):
    state = spark.createDataFrame([(i, "extract_pending") for i in ids], STATE)
    return {"state": state, "messages": spark.createDataFrame([(i, i, "ocr.completed") for i in ids], MESSAGES)}


def seen(spark, root):
    return tuple(sorted(r["doc_id"] for r in batches.read_batches(spark, root, name, schema).collect()) for name, schema in (("state", STATE), ("messages", MESSAGES)))


def test_a_small_object_is_put_once(spark, tmp_path):
    path = f"file://{tmp_path}/a/b.json"
    assert objects.put_if_absent(spark, path, b"one") and not objects.put_if_absent(spark, path, b"two")
    assert objects.read_small(spark, path) == b"one" and objects.names_below(spark, f"file://{tmp_path}/a") == ["b.json"]
    assert objects.names_below(spark, f"file://{tmp_path}/none") == [] and len(list((tmp_path / "a").iterdir())) <= 2


def test_tables_become_visible_together(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/tables"
    assert seen(spark, root) == ([], [])
    assert batches.commit_batch(spark, root, 0, rows(spark, [1, 2]))

    def stopped(*_):
        raise RuntimeError("stopped before the manifest")

    with monkeypatch.context() as broken:
        broken.setattr(batches, "put_if_absent", stopped)
        with pytest.raises(RuntimeError, match="stopped"):
            batches.commit_batch(spark, root, 1, rows(spark, [3]))
    # the rows are there, nobody sees them
    assert len(objects.names_below(spark, f"{root}/state")) == 2 and seen(spark, root) == ([1, 2], [1, 2])
    assert batches.commit_batch(spark, root, 1, rows(spark, [3])) and seen(spark, root) == ([1, 2, 3], [1, 2, 3])
    assert not batches.commit_batch(spark, root, 1, rows(spark, [3])) and seen(spark, root) == ([1, 2, 3], [1, 2, 3])
    # a table that stops between the two writes
    half = rows(spark, [4]) | {"messages": spark.createDataFrame([(1,)], "x long").select(F.raise_error(F.lit("lost")).alias("id"))}
    with pytest.raises(Exception, match="lost"):
        batches.commit_batch(spark, root, 2, half)
    assert seen(spark, root) == ([1, 2, 3], [1, 2, 3])


def test_of_two_writers_of_a_number_one_commits(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/tables"
    monkeypatch.setattr(batches, "exists", lambda *_: False)  # both looked before either wrote
    assert batches.commit_batch(spark, root, 7, rows(spark, [1])) and not batches.commit_batch(spark, root, 7, rows(spark, [9]))
    monkeypatch.undo()
    assert seen(spark, root) == ([1], [1])


def test_compaction_changes_no_rows(spark, tmp_path):
    root, schemas = f"file://{tmp_path}/tables", {"state": STATE, "messages": MESSAGES}
    assert not batches.compact_batches(spark, root, schemas)
    for n in range(5):
        batches.commit_batch(spark, root, n, rows(spark, [2 * n, 2 * n + 1]) if n else {"state": rows(spark, [0])["state"]})
    before = seen(spark, root)
    assert batches.compact_batches(spark, root, schemas) and seen(spark, root) == before
    assert len(batches._committed(spark, root)) == 1
    batches.commit_batch(spark, root, 5, rows(spark, [77]))
    assert seen(spark, root)[0] == sorted([*before[0], 77]) and batches.compact_batches(spark, root, schemas)
    assert seen(spark, root)[1] == sorted([*before[1], 77])


def test_relay_hands_on_what_is_committed_until_it_arrives(spark, tmp_path):
    root, told = f"file://{tmp_path}/tables", []

    def run(deliver):
        batches.relay_batches(spark, root, "messages", MESSAGES, deliver, f"file://{tmp_path}/relay").awaitTermination()

    def keep(frame, number):
        told.extend(r["id"] for r in frame.collect())

    def fail(frame, number):
        raise RuntimeError("the broker is away")

    batches.commit_batch(spark, root, 0, rows(spark, [1, 2]))
    with pytest.raises(Exception, match="away"):
        run(fail)
    run(keep)
    assert sorted(told) == [1, 2]
    (tmp_path / "tables" / "messages" / "left-behind").mkdir()
    batches.commit_batch(spark, root, 1, rows(spark, [5]))
    run(keep)
    assert sorted(told) == [1, 2, 5]


def shout(images):
    return [(image.decode().upper(), 0.5) for image in images]


@pytest.mark.parametrize("after", [False, True])
def test_a_failure_between_writes_leaves_one_completion(spark, tmp_path, monkeypatch, after):
    """Stopped just before, or just after, the first batch's manifest is put."""
    root = f"file://{tmp_path}/tables"
    images = spark.createDataFrame([(d, p, f"page {d}.{p}".encode()) for d in range(4) for p in range(5)], "doc_id long, page_no int, image binary")
    # documents 0 to 2 of three shards, the first delivered twice; 3 lacks one; 4 has no pages
    told = [(d, s, 3, 2 * s, min(5, 2 * s + 2)) for d in range(4) for s in range(3) if (d, s) != (3, 1)] + [(0, s, 3, 2 * s, min(5, 2 * s + 2)) for s in range(3)] + [(4, 0, 1, 0, 0)]
    frame = spark.createDataFrame([(k, str(m[0]), f"t{k % 4}", '{"shard_idx":%d,"shards_total":%d,"page_start":%d,"page_end":%d}' % m[1:]) for k, m in enumerate(told)], "id long, doc_id string, topic string, payload string")
    publish(frame.withColumn("created_at", F.lit("2024-01-01").cast("timestamp")), f"file://{tmp_path}/queue")

    def start():
        queue = subscribe(spark, f"file://{tmp_path}/queue", files_per_batch=2)
        asked = queue.select(F.col("doc_id").cast("long").alias("doc_id"), F.from_json("payload", shardchain.MESSAGE).alias("m")).select("doc_id", "m.*")
        shardchain.run_shards(asked, images, shout, root, f"file://{tmp_path}/checkpoint").awaitTermination()

    put, read = batches.put_if_absent, lambda name: batches.read_batches(spark, root, name, shardchain.TABLES[name])

    def stopped(*args):
        if after:
            put(*args)
        raise RuntimeError("stopped at the manifest")

    with monkeypatch.context() as broken:
        broken.setattr(batches, "put_if_absent", stopped)
        with pytest.raises(Exception, match="stopped"):
            start()
    assert objects.names_below(spark, f"{root}/outputs")
    assert (read("claims").count() > 0) == after
    start()
    start()  # nothing is left to do
    assert sorted(r["doc_id"] for r in read("messages").collect()) == [0, 1, 2, 4]
    claims = sorted(tuple(r) for r in read("claims").collect())
    assert claims == sorted({(m[0], m[1]) for m in told})
    outputs = {(r["doc_id"], r["shard_idx"]): [(p["page_no"], p["text"], p["confidence"]) for p in r["pages"]] for r in read("outputs").collect()}
    assert len(outputs) == read("outputs").count() == len(claims)
    assert outputs[(1, 2)] == [(4, "PAGE 1.4", 0.5)] and outputs[(4, 0)] == [] and outputs[(0, 0)] == [(0, "PAGE 0.0", 0.5), (1, "PAGE 0.1", 0.5)]


def test_pages_without_an_image_have_no_text(spark):
    pages = spark.createDataFrame([(1, b"a"), (2, None)], "page_no int, image binary")
    assert sorted(tuple(r) for r in shardchain.recognise(pages, shout).collect()) == [(1, "A", 0.5), (2, "", 0.5)]


@pytest.mark.parametrize("after", [False, True])
def test_state_and_messages_are_seen_together(spark, tmp_path, monkeypatch, after):
    """Stopped before or behind the manifest of the second batch; the fold goes on from
    the state that was committed with the first."""
    root, source = f"file://{tmp_path}/tables", f"file://{tmp_path}/in"
    write = lambda rows: spark.createDataFrame(rows, "doc_id long, seq long, to_state string").coalesce(1).write.mode("append").parquet(source)

    def start():
        stream = spark.readStream.schema("doc_id long, seq long, to_state string").parquet(source)
        outbox.run_transitions(stream, root, f"file://{tmp_path}/checkpoint").awaitTermination()

    def now():
        sent = sorted((r["doc_id"], r["topic"]) for r in batches.read_batches(spark, root, "messages", outbox.TABLES["messages"]).collect())
        return {r["doc_id"]: r["state"] for r in outbox.current(spark, root).collect()}, sent

    write([(1, 1, "text_running"), (2, 1, "text_running"), (2, 2, "extract_pending")])
    start()
    first = ({1: "text_running", 2: "extract_pending"}, [(2, "ocr.completed")])
    assert now() == first
    write([(1, 5, "extract_pending"), (2, 6, "extract_running"), (2, 7, "complete"), (3, 8, "complete")])
    put = batches.put_if_absent

    def stopped(*args):
        if after:
            put(*args)
        raise RuntimeError("stopped at the manifest")

    last = ({1: "extract_pending", 2: "complete", 3: "text_pending"}, [(1, "ocr.completed"), (2, "document.extracted"), (2, "ocr.completed"), (3, "triage.requests")])
    with monkeypatch.context() as broken:
        broken.setattr(batches, "put_if_absent", stopped)
        with pytest.raises(Exception, match="stopped"):
            start()
    assert now() == (last if after else first)
    start()
    assert now() == last
