"""Operator actions: redrive, override and kill switch, each with its audit row.

Nothing is changed in place: an action returns the ledger events, messages and
audit rows to append.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.operators import recon


class Refused(ValueError):
    """The action lacks a reason or does not apply."""


class Action(NamedTuple):
    events: DataFrame
    messages: DataFrame
    audit: DataFrame
    errors: DataFrame


def _require(reason: str) -> None:
    if not reason or not reason.strip():
        raise Refused("a reason is required")


def _audit(rows: DataFrame, action: str, reason: str, actor: str) -> DataFrame:
    return rows.select(
        "doc_id", F.lit(action).alias("action"), F.lit(reason).alias("reason"), F.lit(actor).alias("actor"),
        F.to_json(F.struct(F.col("state").alias("from_state"), F.col("target").alias("to_state"))).alias("detail"),
    )


def force_redrive(ledger: DataFrame, assembled: DataFrame, deliveries: DataFrame, reason: str, actor: str, shard_size: int = 1) -> Action:
    """Redrive the given documents of review or failed; others are errors.  The
    messages are those that the sweeper would publish for the new state."""
    _require(reason)
    told = recon.redrive_targets(ledger, assembled)
    moved = told.where("error IS NULL")
    claimed = ledger.drop("state").join(moved.select("doc_id", F.col("target").alias("state")), "doc_id")
    return Action(
        moved.select("doc_id", F.col("target").alias("to_state")),
        recon.redrive(claimed, deliveries, shard_size),
        _audit(moved, "force_redrive", reason, actor),
        told.where("error IS NOT NULL").select("doc_id", "error"),
    )


def bulk_redrive(
    ledger: DataFrame, predicate: str, assembled: DataFrame, deliveries: DataFrame, reason: str, actor: str, cap: int = 25, approved: bool = False
) -> Action:
    """``force_redrive`` of what ``predicate`` matches; refused beyond ``cap``
    without approval."""
    _require(reason)
    matched = ledger.where(F.expr(predicate))
    if not approved and matched.limit(cap + 1).count() > cap:
        raise Refused(f"more than {cap} documents match; approval is needed")
    return force_redrive(matched, assembled, deliveries, reason, actor)


def accept_review(ledger: DataFrame, reason: str, actor: str) -> Action:
    """Complete documents of review against their gates; says so ever after."""
    accepted = recon.accept_review(ledger, actor, reason) if reason and reason.strip() else _require(reason)
    audit = _audit(accepted.select("doc_id", F.lit("review").alias("state"), F.lit("complete").alias("target")), "accept_review", reason, actor)
    refused = ledger.where("state <> 'review'").select("doc_id", F.lit("not_review").alias("error"))
    return Action(accepted.select("doc_id", F.col("state").alias("to_state"), "override", "detail"), accepted.select("doc_id", "topic"), audit, refused)


def set_flag(flags: DataFrame, key: str, value: bool, reason: str, actor: str) -> tuple[DataFrame, DataFrame]:
    """The flag events with one more, and the audit row (of no document)."""
    _require(reason)
    spark = flags.sparkSession
    after = flags.agg(F.coalesce(F.max("seq") + 1, F.lit(0)).alias("seq")).select(F.lit(key).alias("key"), "seq", F.lit(value).alias("value"))
    audit = spark.createDataFrame([(None, "set_flag", reason, actor, f'{{"{key}":{str(value).lower()}}}')], "doc_id long, action string, reason string, actor string, detail string")
    return flags.unionByName(after), audit
