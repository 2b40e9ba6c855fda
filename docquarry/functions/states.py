"""The document state machine as data and as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# States, and the legal transitions between them.
TEXT_STATES = ("text_pending", "text_running")
EXTRACT_STATES = ("extract_pending", "extract_running")
IN_FLIGHT = TEXT_STATES + EXTRACT_STATES
STATES = IN_FLIGHT + ("complete", "review", "failed")
TERMINAL = ("complete", "review", "failed")
TRANSITIONS = {
    "text_pending": ("text_running",),
    "text_running": ("extract_pending", "text_pending", "review", "failed"),
    "extract_pending": ("extract_running",),
    "extract_running": ("complete", "review", "extract_pending", "failed"),
    "review": ("extract_pending", "complete"),
    "failed": ("text_pending", "extract_pending"),
}


def transition_map() -> Column:
    """State to the states that may follow it, as a literal map."""
    pairs = [x for a, bs in TRANSITIONS.items() for x in (F.lit(a), F.array(*[F.lit(b) for b in bs]))]
    return F.create_map(*pairs)


def transition_table(spark: SparkSession) -> DataFrame:
    """The legal edges: ``from_state``, ``to_state``."""
    return spark.createDataFrame([(a, b) for a, bs in TRANSITIONS.items() for b in bs], "from_state string, to_state string")


def may_follow(state: Column, target: Column, idempotent: bool = True) -> Column:
    """Whether ``target`` may follow ``state``; with ``idempotent`` also itself."""
    legal = F.coalesce(F.array_contains(F.try_element_at(transition_map(), state), target), F.lit(False))
    return legal | (state == target) if idempotent else legal


def pending_of(state: Column) -> Column:
    return F.regexp_replace(state, "_running$", "_pending")
