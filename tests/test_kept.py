"""Leases and claims, the kept fold and the kept log."""

import os
import random
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from docquarry.operators import incremental, recon
from docquarry.operators.ledger import last_values, transition_fold
from docquarry.sources import leases, objects, versions

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_versions_are_put_once(spark, tmp_path):
    root = f"file://{tmp_path}/v"
    assert versions.latest(spark, root) == (0, {})
    assert versions.put_version(spark, root, 1, {"a": 1}) and not versions.put_version(spark, root, 1, {"a": 2})
    assert versions.latest(spark, root) == (1, {"a": 1})
    tried = []

    def slow(number, told):
        tried.append(number)
        if len(tried) == 1:  # somebody else is quicker
            versions.put_version(spark, root, number + 1, {"a": 7})
        return {"a": told["a"] + 1}

    assert versions.change(spark, root, slow) == {"a": 8} and tried == [1, 2]
    assert versions.change(spark, root, lambda n, t: None) == {"a": 8} and versions.latest(spark, root)[0] == 3
    with pytest.raises(RuntimeError, match="quicker"):
        versions.change(spark, root, lambda n, t: versions.put_version(spark, root, n + 1, t) and t, tries=2)


def test_a_range_has_one_holder_until_its_lease_runs_out(spark, tmp_path):
    root = f"file://{tmp_path}/l"
    take = lambda who, now, most=None: leases.take_ranges(spark, root, who, 4, now, 100, most)
    assert take("a", 0, 2) == [0, 1] and take("b", 10) == [2, 3] and take("c", 50) == []
    assert take("a", 90) == [0, 1]  # renewed, to 190
    assert take("c", 120) == [2, 3] and take("b", 130) == []
    leases.give_back(spark, root, "a", 4)
    assert take("b", 140) == [0, 1]


def test_a_late_claim_holds_nothing(spark, tmp_path, monkeypatch):
    """A sweeper that lost its lease while it worked and did not notice."""
    root = f"file://{tmp_path}/l"
    rows = spark.range(200).select(F.col("id").alias("doc_id"), F.lit("x").alias("state"))
    real = leases.claimed

    def overtaken(session, where, schema, parts):
        found = real(session, where, schema, parts)
        monkeypatch.setattr(leases, "claimed", real)
        leases.claim(spark, root, rows, "doc_id", [0, 1], 4, "quick")
        return found

    monkeypatch.setattr(leases, "claimed", overtaken)
    mine, late = leases.claim(spark, root, rows, "doc_id", [0, 1, 2], 4, "slow")
    assert sorted(late) == [0, 1] and mine.count() > 0
    assert mine.where(leases.range_of("doc_id", 4) != 2).count() == 0
    every, _ = leases.claimed(spark, root, "doc_id long, state string", [0, 1, 2, 3])
    assert every.count() == every.distinct().count() == rows.where(leases.range_of("doc_id", 4) < 3).count()


SWEEPER = """
import sys, time
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
from docquarry.sources import leases
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.sql.warehouse.dir", {store!r} + "/wh").getOrCreate()
who, root = sys.argv[1], {store!r} + "/sweeps"
rows = spark.range(1000).select(F.col("id").alias("doc_id"))
for turn in range(6):
    held = leases.take_ranges(spark, root, who, 8, int(time.time() * 1000), 3000, most=5)
    mine, late = leases.claim(spark, root, rows, "doc_id", held, 8, who)
    print("MINE", *[r["doc_id"] for r in mine.collect()], flush=True)
    time.sleep(1)
"""


def test_two_processes_claim_disjoint_rows(tmp_path):
    script = tmp_path / "sweeper.py"
    script.write_text(textwrap.dedent(SWEEPER.format(root=ROOT, store=f"file://{tmp_path}")))
    both = [subprocess.Popen([sys.executable, str(script), who], stdout=subprocess.PIPE, stderr=subprocess.PIPE, text=True) for who in ("one", "two")]
    told = [p.communicate(timeout=300) for p in both]
    assert [p.returncode for p in both] == [0, 0], told[0][1][-2000:] + told[1][1][-2000:]
    mine = [[int(x) for line in out.splitlines() if line.startswith("MINE") for x in line.split()[1:]] for out, _ in told]
    assert sorted(mine[0] + mine[1]) == list(range(1000)) and mine[0] and mine[1]


def requests(rng, n, docs, first=0):
    states = ["text_running", "extract_pending", "extract_running", "review", "complete", "failed", "text_pending"]
    return [(rng.randrange(docs), first + k, rng.choice(states)) for k in range(n)]


def test_a_kept_fold_equals_the_fold_of_everything(spark, tmp_path):
    rng, root, schema = random.Random(5), f"file://{tmp_path}/fold", "doc_id long, seq long, to_state string"
    every, changed = [], []
    for turn in range(4):
        fresh = requests(rng, 60 if turn % 2 else 200, 3 if turn % 2 else 50, 1000 * turn)
        every += fresh
        frame = spark.createDataFrame(every, schema)  # the log as it is now, old requests too
        changed.append(incremental.fold_in(spark, root, frame, "doc_id", "seq", "to_state", buckets=16))
        want = transition_fold(frame, "doc_id", "seq", "to_state")
        got = incremental.read_fold(spark, root, "doc_id")
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # three documents are in three buckets at most, and the others' files stay
    assert len(changed[1]) <= 3 and len(changed[0]) > 8
    _, told = versions.latest(spark, root)
    last = {f.rpartition("/")[0] for b, f in told["buckets"].items() if int(b) in changed[3]}
    assert len(last) == 1 and all(f.rpartition("/")[0] not in last for b, f in told["buckets"].items() if int(b) not in changed[3])
    # again changes nothing
    assert incremental.fold_in(spark, root, frame, "doc_id", "seq", "to_state", buckets=16) == [] and versions.latest(spark, root)[1] == told
    read = incremental.read_fold(spark, root, "doc_id", buckets=changed[3]).inputFiles()
    assert 0 < len(read) <= len(changed[3])


def test_a_fold_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, seq long, to_state string")
    assert incremental.fold_in(spark, f"file://{tmp_path}/f", empty, "doc_id", "seq", "to_state") == []
    assert incremental.read_fold(spark, f"file://{tmp_path}/f", "doc_id").count() == 0


def test_pruning_drops_files_and_cuts_one(spark, tmp_path):
    root, schema = f"file://{tmp_path}/log", "id long, doc_id long, started_at timestamp, ended_at timestamp"
    at = F.coalesce("ended_at", "started_at")
    log = spark.range(4000).select(
        "id", (F.col("id") % 7).alias("doc_id"),
        F.when(F.col("id") % 4 > 0, F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60)).alias("started_at"),
        F.when(F.col("id") % 3 > 0, F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60)).alias("ended_at"),
    )
    for a, b in ((0, 2500), (2500, 4000)):
        incremental.append_log(spark, root, log.where(f"id >= {a} AND id < {b}"), "id", at, files=10)
    whole = versions.latest(spark, root)[1]["files"]
    assert len(whole) == 20 and sum(f["rows"] for f in whole) == 4000
    for days in (2.0, 1.0, 0.2):
        as_of = F.timestamp_seconds(F.lit(1_700_000_000 + 4000 * 60))
        cutoff = as_of - F.make_dt_interval(days=F.lit(0), secs=F.lit(days * 86_400))
        old = log.where(at < cutoff).agg(F.max("id")).first()[0]
        want = sorted(r["id"] for r in log.where(F.col("id") > old).collect())
        did = incremental.prune_log(spark, root, "id", at, cutoff)
        left = incremental.read_log(spark, root, schema)
        assert sorted(r["id"] for r in left.collect()) == want
        assert did["rewritten"] <= 1 and did["read"] <= 2 and did["dropped"] >= 1
    assert incremental.prune_log(spark, root, "id", at, cutoff) == {"read": 0, "dropped": 0, "rewritten": 0}
    on_disk = [n for f in (tmp_path / "log" / "files").iterdir() for n in f.iterdir() if n.name.startswith("part")]
    assert len(on_disk) == len(versions.latest(spark, root)[1]["files"])


def test_a_log_without_times_or_rows_is_left_alone(spark, tmp_path):
    root, at = f"file://{tmp_path}/log", F.coalesce("ended_at", "started_at")
    rows = spark.range(10).select("id", F.lit(None).cast("timestamp").alias("started_at"), F.lit(None).cast("timestamp").alias("ended_at"))
    incremental.append_log(spark, root, rows.limit(0), "id", at)
    assert versions.latest(spark, root) == (0, {})
    incremental.append_log(spark, root, rows, "id", at)
    assert incremental.prune_log(spark, root, "id", at, F.lit("2030-01-01").cast("timestamp"))["dropped"] == 0
    assert recon.prune(rows, F.lit("2030-01-01").cast("timestamp"), 1).count() == incremental.read_log(spark, root, "id long").count() == 10
    assert objects.exists(spark, f"{root}/files")


def test_kept_last_values_equal_those_of_everything(spark, tmp_path):
    rng, root, kinds = random.Random(6), f"file://{tmp_path}/values", {"a": "string", "b": "long"}
    every, schema = [], "doc_id long, seq long, a string, b long"
    for turn in range(3):
        docs = 40 if turn != 1 else 2
        every += [(rng.randrange(docs), 100 * turn + k, rng.choice([None, "x", "y"]), rng.choice([None, k])) for k in range(60)]
        frame = spark.createDataFrame(every, schema)
        changed = incremental.fold_last_values(spark, root, frame, "doc_id", "seq", kinds, buckets=16)
        assert turn != 1 or len(changed) <= 2
        want = last_values(frame, "doc_id", "seq", ["a", "b"])
        assert sorted(map(tuple, incremental.read_last_values(spark, root, "doc_id", kinds).collect())) == sorted(map(tuple, want.collect()))
    assert incremental.fold_last_values(spark, root, frame, "doc_id", "seq", kinds, buckets=16) == []
