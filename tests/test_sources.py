import ast
import pathlib

import pytest
from pyspark.sql import functions as F

import docquarry
from docquarry.sources import artifacts, extractors, objects, queue, readonly, statements
from tests.test_expressions import CLEAN


def test_objects(spark, tmp_path):
    (tmp_path / "inbox").mkdir()
    for name, data in [("a.pdf", b"one"), ("b.pdf", b""), ("c.txt", b"one")]:
        (tmp_path / "inbox" / name).write_bytes(data)
    base = f"file://{tmp_path}/inbox"
    listed = objects.list_objects(spark, base, "*.pdf")
    assert sorted(r["size"] for r in listed.collect()) == [0, 3]
    assert "content" not in listed.columns
    ids = {r["path"].rpartition("/")[2]: r["content_id"] for r in objects.read_objects(spark, base).collect()}
    assert ids["a.pdf"] == ids["c.txt"] != ids["b.pdf"]
    assert objects.exists(spark, base) and not objects.exists(spark, base + "/nope")
    objects.ensure_folder(spark, base + "/new")
    assert objects.delete_prefix(spark, base) and not objects.exists(spark, base)


def test_artifacts(spark, tmp_path):
    folder = f"file://{tmp_path}/shards"
    assert artifacts.read_artifacts(spark, folder, artifacts.SHARD).count() == 0
    rows = [("d", 1, [(2, "c", 0.5)]), ("d", 0, [(1, "b", None), (0, "a", 0.9)])]
    artifacts.write_artifacts(spark.createDataFrame(rows, artifacts.SHARD), folder)
    artifacts.write_artifacts(spark.createDataFrame(rows, artifacts.SHARD), folder)
    made = artifacts.assemble_outputs(artifacts.read_artifacts(spark, folder, artifacts.SHARD), "ocr-test").collect()
    assert [(r["doc_id"], [p["text"] for p in r["pages"]]) for r in made] == [("d", ["a", "b", "c"])]


def messages(spark, ids):
    return spark.createDataFrame([(i, f"d{i % 3}", "t1" if i % 2 else "t2", '{"n": %d}' % i) for i in ids], "id long, doc_id string, topic string, payload string").withColumn(
        "created_at", F.lit("2024-01-01").cast("timestamp")
    )


def test_relay_delivers_all_or_replays(spark, tmp_path):
    root, seen, fail = f"{tmp_path}/q", [], [True]
    queue.ensure_topics(spark, root, ["t1", "t2"])
    queue.publish(messages(spark, range(6)), root)

    def deliver(batch, number):
        ids = [r["id"] for r in batch.orderBy("id").collect()]
        if fail[0]:
            return len(ids) - 1
        seen.extend(ids)
        return len(ids)

    with pytest.raises(Exception, match="not delivered"):
        queue.relay(queue.subscribe(spark, root), deliver, f"{tmp_path}/cp").awaitTermination()
    fail[0] = False
    queue.relay(queue.subscribe(spark, root), deliver, f"{tmp_path}/cp").awaitTermination()
    assert sorted(seen) == list(range(6))
    queue.publish(messages(spark, [7]), root)
    queue.relay(queue.subscribe(spark, root, ["t1"]), deliver, f"{tmp_path}/cp").awaitTermination()
    assert sorted(seen) == [*range(6), 7]


def test_decoding_and_posting_once(spark, tmp_path):
    bad = messages(spark, [1]).withColumn("payload", F.lit("no json"))
    told = queue.decoded(messages(spark, [2]).unionByName(bad), "n int").orderBy("id").collect()
    assert told[0]["body"]["n"] is None and told[1]["body"]["n"] == 2
    folder = f"{tmp_path}/posted"
    rows = messages(spark, range(5)).select("id", "doc_id")
    queue.post_once(rows, folder)
    queue.post_once(rows.unionByName(messages(spark, [9]).select("id", F.lit("new").alias("doc_id"))), folder)
    assert sorted((r["doc_id"], r["id"]) for r in spark.read.parquet(folder).collect()) == [("d0", 0), ("d1", 1), ("d2", 2), ("new", 9)]


def test_statements(spark):
    frame = spark.createDataFrame([(1, "failed", None, "p1"), (2, "failed", "b1", "p1"), (3, "review", None, None)], "doc_id long, state string, build_sha string, prompt_version string")
    got = statements.run(spark, "reconciliation", "replayable", {"ledger": frame}, build="b1", prompt="p1")
    assert [r["doc_id"] for r in got.collect()] == [1]
    with pytest.raises(ImportError):
        statements.run(spark, "reconciliation", "nope", {})
    with pytest.raises(ValueError):
        statements.parse("-- name: a\nSELECT 1\n-- name: a\nSELECT 2")
    evil = statements.run(spark, "reconciliation", "replayable", {"ledger": frame}, build="x' OR '1'='1", prompt="p1")
    assert sorted(r["doc_id"] for r in evil.collect()) == [1, 2]


def test_read_only_role(spark):
    ledger = spark.createDataFrame([(1, "failed")], "doc_id long, state string")
    role = readonly.ReadOnlyLedger(spark, {"ledger": ledger, "outbox": ledger})
    assert role.table("ledger").count() == 1 and role.run("reconciliation", "state_counts").count() == 1
    with pytest.raises(readonly.Denied):
        role.table("outbox")


def test_extractor_behaviours(spark):
    asked = spark.createDataFrame([(d, a, CLEAN) for d in range(8) for a in (1, 2)], "doc_id long, attempt int, source_text string")
    behave = [
        (1, None, "refusal", None), (2, None, "429", None), (3, None, "not_grounded", None), (4, None, "injected_total", 7), (5, None, "diverge_on_redelivery", None),
        (6, None, "swapped_roles", None), (7, None, "schema_invalid", None), (7, 2, "correct", None),
    ]
    made = extractors.LabelExtractor(spark.createDataFrame(behave, "doc_id long, attempt int, behaviour string, total_cents long")).extract(asked)
    got = {(r["doc_id"], r["attempt"]): (r["error"], r["record"] and r["record"]["total_cents"], r["record"] and r["record"]["seller"]) for r in made.collect()}
    assert got[0, 1] == (None, 160050, "Acme GmbH") and got[1, 1] == ("refusal", None, None) and got[2, 2][0] == "transient"
    assert got[3, 1][1] == 160050 + 999_999 and got[4, 2][1] == 7 and got[6, 1][2] == "Beta Ltd"
    assert (got[5, 1][1], got[5, 2][1]) == (160050, 160150) and (got[7, 1][0], got[7, 2][0]) == ("schema_invalid", None)
    assert extractors.LabelExtractor().extract(asked).where("error IS NOT NULL").count() == 0


def test_no_statement_is_formatted():
    """SQL reaches Spark only as constants or with bound parameters."""
    root = pathlib.Path(docquarry.__file__).parent
    for file in root.rglob("*.py"):
        for node in ast.walk(ast.parse(file.read_text())):
            if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and node.func.attr == "sql" and node.args:
                assert not isinstance(node.args[0], (ast.JoinedStr, ast.BinOp)), f"{file}:{node.lineno}"
