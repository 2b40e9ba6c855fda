"""Reconciliation: orphans, stuck work, redrives, reports and retention.

``as_of`` is always given; no operator reads the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.functions.states import EXTRACT_STATES, IN_FLIGHT, TERMINAL, TEXT_STATES, pending_of
from docquarry.functions.text import page_range, shard_path


def orphans(objects: DataFrame, known: DataFrame, pending: DataFrame, key: str) -> DataFrame:
    """Objects neither in the ledger nor waiting in the queue."""
    return objects.join(known.select(key), key, "left_anti").join(pending.select(key).distinct(), key, "left_anti")


def is_stuck(as_of: Column, text_seconds: int, extract_seconds: int) -> Column:
    age = lambda s: F.col("state_updated_at") < as_of - F.make_dt_interval(secs=F.lit(s))
    return (F.col("state").isin(*TEXT_STATES) & age(text_seconds)) | (F.col("state").isin(*EXTRACT_STATES) & age(extract_seconds))


def stuck_claim(ledger: DataFrame, as_of: Column, cap: int, text_seconds: int = 30, extract_seconds: int = 30) -> DataFrame:
    """The batch a sweep claims: most urgent, then longest stuck, then doc_id.
    A limit after an order is a top-k per task, not a full sort."""
    return (
        ledger.where(is_stuck(as_of, text_seconds, extract_seconds))
        .orderBy(F.col("priority").desc_nulls_last(), F.col("state_updated_at").asc_nulls_last(), F.col("doc_id"))
        .limit(cap)
    )


def sweep_actions(claimed: DataFrame, text_cap: int = 5, extract_cap: int = 5) -> DataFrame:
    """Adds ``action`` (fail or redrive), ``next_state``, ``reason`` and
    ``burns_attempt``.  Only running documents use up attempts."""
    running, text = F.col("state").endswith("_running"), F.col("state").startswith("text_")
    attempts = F.when(text, F.col("text_attempts")).otherwise(F.col("extract_attempts"))
    cap = F.when(text, text_cap).otherwise(extract_cap)
    spent = running & (attempts >= cap)
    reason = F.concat(
        F.lit("sweeper: exceeded attempt cap in "), F.col("state"), F.lit(" ("), attempts.cast("string"), F.lit("/"), cap.cast("string"), F.lit(")")
    )
    return claimed.select(
        "*",
        F.when(spent, "fail").otherwise("redrive").alias("action"),
        F.when(spent, F.lit("failed")).otherwise(pending_of(F.col("state"))).alias("next_state"),
        F.when(spent, reason).alias("reason"),
        (running & ~spent).alias("burns_attempt"),
    )


def text_topic(has_text_layer: Column, pages: Column, shard_size: int) -> Column:
    return F.when(F.coalesce(has_text_layer, F.lit(False)), "text.embedded").when(pages <= shard_size, "ocr.shard").otherwise("ocr.split")


def redrive(claimed: DataFrame, deliveries: DataFrame, shard_size: int = 1, bucket: str = "inbox") -> DataFrame:
    """The messages a redrive publishes: ``doc_id``, ``topic``, ``shard_idx``,
    ``page_start``, ``page_end``, ``path``.  ``claimed`` has the state before
    the claim; ``deliveries`` has ``doc_id``, ``shard_idx``."""
    many = F.col("shards_total") > 1
    topic = (
        F.when(F.col("state").isin(*EXTRACT_STATES), "ocr.completed")
        .when(~many, text_topic(F.col("has_text_layer"), F.col("page_count"), shard_size))
        .otherwise("ocr.split")
    )
    sharded = (F.col("state") == "text_running") & many
    whole = claimed.where(~sharded & F.col("state").isin(*IN_FLIGHT)).withColumn("topic", topic)
    single = F.col("topic") == "ocr.shard"
    whole = whole.select(
        "doc_id",
        "topic",
        F.when(single, 0).alias("shard_idx"),
        F.when(single, 0).alias("page_start"),
        F.when(single, F.col("page_count")).cast("int").alias("page_end"),
        F.when(F.col("topic") != "ocr.completed", F.col("gcs_path")).alias("path"),
    )
    wanted = claimed.where(sharded).select("doc_id", "page_count", F.explode(page_range(F.col("shards_total"))).alias("shard_idx"))
    lacking = wanted.join(deliveries.select("doc_id", F.col("shard_idx").cast("int").alias("shard_idx")), ["doc_id", "shard_idx"], "left_anti")
    index = F.col("shard_idx")
    parts = lacking.select(
        "doc_id",
        F.lit("ocr.shard").alias("topic"),
        index,
        (index * shard_size).cast("int").alias("page_start"),
        F.least(index * shard_size + shard_size, F.col("page_count")).cast("int").alias("page_end"),
        F.concat(F.lit(f"gs://{bucket}/"), shard_path(F.col("doc_id"), index)).alias("path"),
    )
    return whole.unionByName(parts)


def replayable(ledger: DataFrame, build: str, prompt: str) -> DataFrame:
    """Failed documents whose build or prompt is not the current one."""
    changed = ~F.col("build_sha").eqNullSafe(F.lit(build)) | ~F.col("prompt_version").eqNullSafe(F.lit(prompt))
    return ledger.where((F.col("state") == "failed") & changed).select("doc_id", "build_sha", "prompt_version")


def liveness(ledger: DataFrame, as_of: Column, window_seconds: int = 900) -> DataFrame:
    """One row: counts in the trailing window, in flight, and ``healthy``.  One
    pass over the ledger."""
    since = as_of - F.make_dt_interval(secs=F.lit(window_seconds))
    counted = ledger.agg(
        F.count_if((F.col("state") == "complete") & (F.col("state_updated_at") > since)).alias("completed_in_window"),
        F.count_if(F.col("created_at") > since).alias("ingested_in_window"),
        F.count_if(F.col("state").isin(*IN_FLIGHT)).alias("in_flight"),
    )
    busy = (F.col("ingested_in_window") > 0) | (F.col("in_flight") > 0)
    return counted.select("*", ((F.col("completed_in_window") > 0) | ~busy).alias("healthy"))


def terminal_report(ledger: DataFrame, as_of: Column, build: str, prompt: str) -> DataFrame:
    """Per state failed and review: total, last 24 hours, oldest, newest, and for
    failed how many no replay will pick up."""
    recent = F.col("state_updated_at") > as_of - F.make_dt_interval(hours=F.lit(24))
    fixed = F.col("build_sha").eqNullSafe(F.lit(build)) & F.col("prompt_version").eqNullSafe(F.lit(prompt))
    return ledger.where(F.col("state").isin("failed", "review")).groupBy("state").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(recent).alias("last_24h"),
        F.min("state_updated_at").alias("oldest"),
        F.max("state_updated_at").alias("newest"),
        F.when(F.col("state") == "failed", F.count_if(fixed)).alias("not_replayable"),
    )


def top_reasons(ledger: DataFrame, k: int = 5, prefix: int = 80) -> DataFrame:
    """The most frequent error prefixes of failed and review documents; ties by
    the reason."""
    counted = (
        ledger.where(F.col("state").isin("failed", "review"))
        .groupBy("state", F.left(F.coalesce("last_error", F.lit("(none)")), F.lit(prefix)).alias("reason"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rank = F.row_number().over(Window.partitionBy("state").orderBy(F.desc("n"), F.asc("reason")))
    return counted.withColumn("rank", rank).where(F.col("rank") <= k)


def prune(log: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """What survives retention: rows above the newest id that is datably old,
    so that undated rows below it go too."""
    old = F.coalesce("ended_at", "started_at") < as_of - F.make_dt_interval(days=F.lit(days))
    mark = log.where(old).agg(F.coalesce(F.max("id"), F.lit(-(1 << 62))).alias("watermark"))
    return log.join(F.broadcast(mark), F.col("id") > F.col("watermark")).drop("watermark")  # one row


def drain_status(ledger: DataFrame) -> DataFrame:
    """One row: ``total``, ``settled``, ``in_flight`` and ``drained``."""
    counted = ledger.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("state").isin(*TERMINAL)).alias("settled"), F.count_if(F.col("state").isin(*IN_FLIGHT)).alias("in_flight")
    )
    return counted.select("*", (F.col("settled") == F.col("total")).alias("drained"))


def drain_watch(polls: DataFrame, by: list[str], quiet_seconds: int, target: int | None = None) -> DataFrame:
    """Adds ``quiet`` (seconds since the total last changed) and ``drained`` to each
    poll (``by``, ``at`` in seconds, ``total``, ``settled``), in order of ``at``.

    A known ``target`` is stable at once; otherwise only a total that has not
    changed for ``quiet_seconds``, two ingest cycles, is.  No documents at all
    never count as drained."""
    order = Window.partitionBy(*by).orderBy("at")
    moved = F.col("total") != F.coalesce(F.lag("total").over(order), F.lit(-1))
    since = F.max(F.when(F.col("_moved"), F.col("at"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    watched = polls.withColumn("_moved", moved).withColumn("quiet", F.col("at") - since)
    stable = F.lit(target is not None) | (F.col("quiet") >= quiet_seconds)
    wanted = F.col("total") if target is None else F.lit(target)
    drained = (F.col("total") > 0) & (F.col("total") >= wanted) & stable & (F.col("settled") == F.col("total"))
    return watched.withColumn("drained", drained).drop("_moved")


def redrive_targets(ledger: DataFrame, assembled: DataFrame) -> DataFrame:
    """``doc_id``, ``state``, ``target`` and ``error`` of a forced redrive;
    ``assembled`` has the doc_ids whose text exists."""
    marked = ledger.join(assembled.select("doc_id", F.lit(True).alias("_done")).distinct(), "doc_id", "left")
    state = F.col("state")
    rejected = (state == "failed") & F.col("page_count").isNull()
    target = F.when(state == "review", "extract_pending").when(
        (state == "failed") & ~rejected, F.when(F.col("_done"), "extract_pending").otherwise("text_pending")
    )
    error = F.when(rejected, "failed_at_triage").when(~state.isin("review", "failed"), "not_review_or_failed")
    return marked.select("doc_id", "state", target.alias("target"), error.alias("error"))


def accept_review(ledger: DataFrame, actor: str, reason: str) -> DataFrame:
    """The override of review: new state, stamped gate results, and the message.

    ``gate_results``, a map of gate to struct of ``outcome`` and ``detail``, keeps
    what the gates said and gains ``operator_override``; an earlier override is
    replaced.  Without the column only the stamp is there."""
    if not reason or not reason.strip():
        raise ValueError("a reason is required")
    stamp = F.to_json(F.struct(F.lit(actor).alias("actor"), F.lit(reason).alias("reason"), F.lit("review").alias("was")))
    override = F.create_map(F.lit("operator_override"), F.struct(F.lit("accepted").alias("outcome"), stamp.alias("detail")))
    merged = override
    if "gate_results" in ledger.columns:
        kept = F.map_filter("gate_results", lambda k, _: k != "operator_override")
        merged = F.when(F.col("gate_results").isNull(), override).otherwise(F.map_concat(kept, override))
    return ledger.where(F.col("state") == "review").select(
        "doc_id",
        F.lit("complete").alias("state"),
        F.lit("document.extracted").alias("topic"),
        F.lit("accepted").alias("override"),
        stamp.alias("detail"),
        merged.alias("gate_results"),
    )


def bulk_redrive(ledger: DataFrame, predicate: str, cap: int = 25, approved: bool = False) -> DataFrame:
    """Documents that match ``predicate`` (parsed as an expression, so nothing
    but a condition fits), with ``matched`` and ``allowed``: beyond ``cap`` none
    is redriven without approval."""
    matched = ledger.where(F.expr(predicate)).select("doc_id", "state")
    count = matched.agg(F.count(F.lit(1)).alias("matched"))
    return matched.join(F.broadcast(count)).select("doc_id", "state", "matched", (F.lit(approved) | (F.col("matched") <= cap)).alias("allowed"))  # one row


def outbox_claim(outbox: DataFrame, n: int) -> DataFrame:
    """The oldest ``n`` messages."""
    return outbox.orderBy("id").limit(n)


def outbox_age(outbox: DataFrame, as_of: Column) -> DataFrame:
    """Seconds since the oldest message; null for an empty queue."""
    oldest = F.min("created_at")
    return outbox.agg(F.timestamp_diff("SECOND", oldest, as_of).alias("age_seconds"))


def watchdog(models: DataFrame, wanted: list[str], by: list[str] = (), cooldown_seconds: int = 0) -> DataFrame:
    """What to do about model placement, a row for each poll in ``by`` (one row
    without).  ``models`` has ``name`` and ``size_vram`` of what is loaded; rows
    with ``reachable`` false mean that nothing is known, so wait.

    Optional columns of a poll: ``since_restart``, seconds since the last
    restart; within the cooldown nothing is restarted again.  ``dry_run``: a
    restart is only told."""
    given = lambda c, other: F.max(c) if c in models.columns else F.lit(other)
    counted = models.groupBy(*by).agg(
        F.coalesce(F.bool_and("reachable"), F.lit(True)).alias("reachable"),
        F.array_sort(F.collect_set(F.when(F.col("size_vram") > 0, F.col("name")))).alias("on_gpu"),
        F.array_sort(F.collect_set(F.when(F.coalesce("size_vram", F.lit(0)) <= 0, F.col("name")))).alias("on_cpu"),
        given("since_restart", None).cast("long").alias("since"),
        F.coalesce(given("dry_run", False), F.lit(False)).alias("dry"),
    )
    missing = F.array_except(F.array(*[F.lit(w) for w in wanted]), F.col("on_gpu"))
    restart = F.when(F.col("dry"), "would_restart").when(F.col("since") < cooldown_seconds, "cooldown").otherwise("restart")
    action = F.when(~F.col("reachable"), "wait").when(F.size("on_cpu") > 0, restart).when(F.size(missing) > 0, "pin").otherwise("nothing")
    return counted.select(
        *by, F.array_join("on_gpu", ",").alias("on_gpu"), F.array_join("on_cpu", ",").alias("on_cpu"), F.array_join(missing, ",").alias("missing"), action.alias("action")
    )
