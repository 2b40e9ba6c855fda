"""Sweeps side by side, the kept fold and the kept log, over the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.operators import incremental, recon
from docquarry.plans import bindings as b
from docquarry.plans.queries import AS_OF, SQL, query
from docquarry.sources import leases
from docquarry.sources.shared import shared_dir

RANGES = 6
LOG = "id long, doc_id long, started_at timestamp_ntz, ended_at timestamp_ntz"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    f"""WITH {b.LEDGER_SQL} SELECT doc_id, state, 1::BIGINT AS claims FROM ledger
WHERE (state IN ('text_pending', 'text_running') AND state_updated_at < {AS_OF} - INTERVAL 86400 SECOND) OR (state IN ('extract_pending', 'extract_running') AND state_updated_at < {AS_OF} - INTERVAL 8640000 SECOND)"""
)
def leased_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sweepers with leases on hash ranges, one of them twice: each stuck document
    is claimed, and once."""
    root = _folder(spark, "leases")
    stuck = b.ledger(spark, sf_dir).where(recon.is_stuck(b.as_of(), 86_400, 8_640_000)).select("doc_id", "state")
    one = leases.take_ranges(spark, root, "sweeper-1", RANGES, 0, 60_000, most=RANGES // 2)
    two = leases.take_ranges(spark, root, "sweeper-2", RANGES, 0, 60_000)
    made = [leases.claim(spark, root, stuck, "doc_id", parts, RANGES, who)[0] for parts, who in ((one, "sweeper-1"), (two, "sweeper-2"), (one, "sweeper-1"))]
    return made[0].unionByName(made[1]).unionByName(made[2]).groupBy("doc_id", "state").agg(F.count(F.lit(1)).alias("claims"))


@query(SQL["transition_fold"])
def incremental_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold of all requests, made in three runs that each read what is new."""
    root, requests = _folder(spark, "fold"), b.requests(spark, sf_dir)
    bounds = requests.agg(F.max("seq").alias("most")).first()["most"] or 0
    for upto in (bounds // 2, bounds - bounds // 10, bounds):
        incremental.fold_in(spark, root, requests.where(F.col("seq") <= upto), "doc_id", "seq", "to_state", buckets=8)
    return incremental.read_fold(spark, root, "doc_id")


@query(SQL["prune_survivors"])
def pruned_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What retention leaves of a log in files of id ranges, pruned twice."""
    root, log = _folder(spark, "log"), b.attempt_log(spark, sf_dir)
    at = F.coalesce("ended_at", "started_at")
    incremental.append_log(spark, root, log, "id", at)
    for days in (20, 10):
        incremental.prune_log(spark, root, "id", at, b.as_of(b.EVENTS_AS_OF) - F.make_dt_interval(days=F.lit(days)))
    return incremental.read_log(spark, root, LOG).select("id", "doc_id")


VALUES = {"kind": "string", "value": "double", "error": "string"}


@query(SQL["last_values"])
def incremental_last_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value of each column, kept over three runs that each read what is new."""
    root = _folder(spark, "values")
    events = b.read(spark, sf_dir, "events").selectExpr(
        "user_id AS doc_id", "event_id", "event_type AS kind", "CASE WHEN event_type = 'view' THEN value END AS value", "CASE WHEN event_type = 'error' THEN props END AS error"
    )
    most = events.agg(F.max("event_id").alias("most")).first()["most"] or 0
    for upto in (most // 2, most - most // 10, most):
        incremental.fold_last_values(spark, root, events.where(F.col("event_id") <= upto), "doc_id", "event_id", VALUES, buckets=8)
    return incremental.read_last_values(spark, root, "doc_id", VALUES)
