"""Inserts, claims, transitions and setters as folds over ordered events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docquarry.functions.states import IN_FLIGHT, TRANSITIONS


def first_per_key(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key: an insert that skips what is there already.

    ``order`` must be total for the result to be determined.  Spark turns the
    rank filter into a group limit, so that each task passes on one row a key.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def insert_if_absent(rows: DataFrame, existing: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The rows that an insert with unique ``key`` would add to ``existing``."""
    return first_per_key(rows, key, order).join(existing.select(*key).distinct(), key, "left_anti")


def winner_order(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Adds ``attempt`` (1 is the first writer) and ``won``."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return rows.withColumn("attempt", rank).withColumn("won", F.col("attempt") == 1)


def unique_commit(rows: DataFrame, unique: list[str], order: list[Column]) -> DataFrame:
    """Adds ``commit_outcome``: of rows with equal, non-null ``unique`` columns
    the first completes, the others go to review."""
    given = F.lit(True)
    for c in unique:
        given = given & F.col(c).isNotNull()
    # rows without a full key compete with nobody: a hash spreads them instead of bringing them together
    alone = F.when(~given, F.xxhash64(*[F.col(c) for c in rows.columns]))
    rank = F.row_number().over(Window.partitionBy(*unique, alone).orderBy(*order))
    return rows.withColumn("commit_outcome", F.when(given & (rank > 1), "review:duplicate").otherwise("complete"))


def last_values(events: DataFrame, key: str, order: str, values: list[str]) -> DataFrame:
    """Last write wins, column by column, nulls not counting as writes.  Partial
    aggregates keep one row per key and task."""
    return events.groupBy(key).agg(*[F.max_by(F.col(v), F.when(F.col(v).isNotNull(), F.col(order))).alias(v) for v in values])


def attempts_since_reset(events: DataFrame, key: str, order: str, kind: str, attempt: str, reset: str) -> DataFrame:
    """``key`` and ``attempts``: events of kind ``attempt`` after the last
    ``reset``.  The reset is found by an aggregate rather than a sort."""
    resets = events.where(F.col(kind) == reset).groupBy(key).agg(F.max(order).alias("_reset"))
    tried = events.where(F.col(kind) == attempt).join(resets, key, "left")
    counted = tried.where(F.col("_reset").isNull() | (F.col(order) > F.col("_reset"))).groupBy(key).agg(F.count(F.lit(1)).alias("attempts"))
    return events.select(key).distinct().join(counted, key, "left").select(key, F.coalesce("attempts", F.lit(0)).cast("long").alias("attempts"))


def transition_fold(
    requests: DataFrame, key: str, order: str, target: str, initial: str = "text_pending", snapshot: DataFrame | None = None
) -> DataFrame:
    """Folds transition requests in order: ``key``, ``state``, ``accepted``,
    ``rejected``, ``last_order`` (of the last accepted; a repeated state counts).

    Per key the requests are gathered and folded by one expression, so a key's
    requests must fit a task.  ``snapshot``, an earlier result, bounds them: the
    fold starts from it and ``requests`` are only those since.
    """
    gathered = requests.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(target).alias("t")))).alias("r"))
    none = F.lit(None).cast("long")
    if snapshot is None:
        gathered = gathered.select("*", F.lit(None).cast("string").alias("_s"), none.alias("_a"), none.alias("_j"), none.alias("_l"))
    else:
        before = snapshot.select(key, F.col("state").alias("_s"), F.col("accepted").alias("_a"), F.col("rejected").alias("_j"), F.col("last_order").alias("_l"))
        gathered = gathered.join(before, key, "full").withColumn("r", F.coalesce("r", F.array().cast(gathered.schema["r"].dataType)))
    zero = F.lit(0).cast("long")
    start = F.struct(
        F.coalesce("_s", F.lit(initial)).alias("state"), F.coalesce("_a", zero).alias("accepted"), F.coalesce("_j", zero).alias("rejected"), F.col("_l").alias("last_order")
    )

    def legal(state: Column, to: Column) -> Column:
        told = state == to
        for a, bs in TRANSITIONS.items():
            told = told | ((state == a) & to.isin(*bs))
        return told

    def step(acc: Column, r: Column) -> Column:
        ok = legal(acc["state"], r["t"])
        return F.struct(
            F.when(ok, r["t"]).otherwise(acc["state"]).alias("state"),
            (acc["accepted"] + F.when(ok, 1).otherwise(0)).alias("accepted"),
            (acc["rejected"] + F.when(ok, 0).otherwise(1)).alias("rejected"),
            F.when(ok, r["o"].cast("long")).otherwise(acc["last_order"]).alias("last_order"),
        )

    return gathered.select(key, F.aggregate("r", start, step).alias("f")).select(key, "f.*")


def divergence(attempts: DataFrame, key: list[str], order: list[Column], result: str) -> DataFrame:
    """Later attempts whose result is not the committed first one."""
    ranked = winner_order(attempts, key, order)
    committed = ranked.where("won").select(*key, F.col(result).alias("committed"))
    return ranked.where("NOT won").join(committed, key).where(F.col(result).isNull() | (F.col(result) != F.col("committed")))


def append_attempts(log: DataFrame, attempts: DataFrame, order: list[str], spread: Column | None = None) -> DataFrame:
    """``attempts`` with the ``id`` that each gets when appended to ``log``: on from
    its greatest, without gaps, by ``spread`` (a hash of the order unless given)
    and then ``order``, which must be total.

    Ids are ranks within a spread plus what the spreads before it hold, so only a
    row per spread is numbered in one task."""
    part = F.pmod(F.xxhash64(*order), F.lit(256)) if spread is None else spread
    dealt = attempts.withColumn("_part", part.cast("long"))
    counts = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(F.col("_part").alias("_at"), (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    start = log.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_start"))
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    numbered = ranked.join(before, F.col("_part") == F.col("_at")).join(F.broadcast(start))  # one row
    return numbered.select((F.col("_start") + F.col("_before") + F.col("_rank")).cast("long").alias("id"), *attempts.columns)


def write_snapshot(folded: DataFrame, folder: str) -> None:
    """Store a fold, work in flight apart from the rest, so that scans for stuck
    or running documents read only their part."""
    marked = folded.withColumn("in_flight", F.col("state").isin(*IN_FLIGHT))
    marked.write.mode("overwrite").partitionBy("in_flight").parquet(folder)
