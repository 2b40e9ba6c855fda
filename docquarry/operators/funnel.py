"""The tiered extraction funnel over logged model calls."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = ("cheap", "strong")
CALLS = 3


def tier_results(calls: DataFrame) -> DataFrame:
    """Per document and tier: the decisive call and what it costs.

    ``calls`` has ``doc_id``, ``tier`` (0, 1), ``call`` (1 ..) and ``kind``: ok,
    refusal, context_overflow, schema_invalid, unparseable or transient.  The
    first ok, refusal or overflow among the first CALLS decides; before it, bad
    replies are repairs and transient faults are retries.
    """
    made = calls.where(F.col("call") <= CALLS)
    decisive = F.col("kind").isin("ok", "refusal", "context_overflow")
    first = made.where(decisive).groupBy("doc_id", "tier").agg(F.min("call").alias("at"), F.min_by("kind", "call").alias("verdict"))
    before = F.col("at").isNull() | (F.col("call") < F.col("at"))
    return made.join(first, ["doc_id", "tier"], "left").groupBy("doc_id", "tier").agg(
        F.coalesce(F.max("verdict"), F.lit("exhausted")).alias("verdict"),
        F.count_if(before & F.col("kind").isin("schema_invalid", "unparseable")).alias("repairs"),
        F.count_if(before & (F.col("kind") == "transient")).alias("retries"),
    )


#: What an attempt is followed by another one for, at the same tier.
AGAIN = ("transient", "unparseable", "schema_invalid")


def call_tier(documents: DataFrame, tier: int, extract: Callable[[DataFrame], DataFrame], keep: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The calls that one tier makes for ``documents`` (``doc_id``, ``source_text``), as
    ``tier_results`` takes them, and the ``record`` of those that gave one.

    A reply that cannot be read or does not fit is asked for again with a hint, a
    transient fault without; anything else settles the document.  ``keep`` writes
    the calls of an attempt, so that none is made twice, whatever fails later.
    """
    waiting, calls, records = documents.select("doc_id", "source_text", F.lit(None).cast("string").alias("hint")), [], []
    for attempt in range(1, CALLS + 1):
        asked = waiting.withColumn("tier", F.lit(tier)).withColumn("attempt", F.lit(attempt))
        told = keep(extract(asked))
        calls.append(told.select("doc_id", "tier", F.col("attempt").alias("call"), F.coalesce("error", F.lit("ok")).alias("kind")))
        records.append(told.where("error IS NULL").select("doc_id", "source_text", "record"))
        waiting = told.where(F.col("error").isin(*AGAIN)).select("doc_id", "source_text", "hint")
    return reduce(DataFrame.unionByName, calls), reduce(DataFrame.unionByName, records)


def run_funnel(calls: DataFrame, blocked: DataFrame) -> DataFrame:
    """``doc_id``, ``outcome``, ``tier_used``, ``repairs``, ``retries``.

    ``blocked`` has ``doc_id``, ``tier``, ``is_blocked`` (of the gates on that
    tier's reply).  Only documents the cheap tier leaves open count on the
    strong one; a refusal ends the funnel.
    """
    told = tier_results(calls).join(blocked, ["doc_id", "tier"], "left")
    passed = (F.col("verdict") == "ok") & ~F.coalesce("is_blocked", F.lit(False))
    state = F.when(passed, "complete").when(F.col("verdict") == "refusal", "refused").otherwise("open")
    judged = told.withColumn("state", state)
    cheap = judged.where("tier = 0")
    closed = cheap.where("state <> 'open'").select(
        "doc_id", "state", F.when(F.col("state") == "complete", TIERS[0]).alias("tier_used"), "repairs", "retries"
    )
    again = cheap.where("state = 'open'").select("doc_id", F.col("repairs").alias("_r"), F.col("retries").alias("_t"))
    strong = again.join(judged.where("tier = 1"), "doc_id", "left").select(
        "doc_id",
        F.coalesce("state", F.lit("open")).alias("state"),
        F.when(F.col("state") == "complete", TIERS[1]).alias("tier_used"),
        (F.col("_r") + F.coalesce("repairs", F.lit(0))).alias("repairs"),
        (F.col("_t") + F.coalesce("retries", F.lit(0))).alias("retries"),
    )
    outcome = F.when(F.col("state") == "complete", "complete").when(F.col("state") == "refused", "review:refusal").otherwise("review:gates_exhausted")
    return closed.unionByName(strong).select("doc_id", outcome.alias("outcome"), "tier_used", "repairs", "retries")
