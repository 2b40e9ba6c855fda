"""Fan-out into shards, their completion, and assembly of their pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.functions.text import page_range


def split(docs: DataFrame, pages: str, size: int) -> DataFrame:
    """A row per shard: ``shard_idx``, ``shards_total``, ``page_start`` and
    ``page_end`` (half open).  A document without pages is one empty shard."""
    total = F.greatest(F.lit(1), F.ceil(F.col(pages) / size)).cast("int")
    return (
        docs.withColumn("shards_total", total)
        .withColumn("shard_idx", F.explode(page_range(F.col("shards_total"))))
        .withColumn("page_start", F.col("shard_idx") * size)
        .withColumn("page_end", F.least((F.col("shard_idx") + 1) * size, F.col(pages)).cast("int"))
    )


def claims(deliveries: DataFrame, doc: str, shard: str) -> DataFrame:
    """Distinct shards; redelivered ones count once."""
    return deliveries.select(doc, shard).distinct()


def completion(docs: DataFrame, deliveries: DataFrame, doc: str, shard: str, total: str) -> DataFrame:
    """``shards_done``, ``missing`` and ``complete`` of every document in
    ``docs``.  One shuffle: distinct shards and their count share a key."""
    done = claims(deliveries, doc, shard).groupBy(doc).agg(F.count(F.lit(1)).alias("shards_done"))
    counted = F.coalesce(F.col("shards_done"), F.lit(0)).cast("long")
    return docs.join(done, doc, "left").select(
        doc,
        F.col(total).cast("long").alias("shards_total"),
        counted.alias("shards_done"),
        (F.col(total) - counted).cast("long").alias("missing"),
        (counted == F.col(total)).alias("complete"),
    )


def missing(docs: DataFrame, deliveries: DataFrame, doc: str, shard: str, total: str) -> DataFrame:
    """``doc``, ``shard``: the shards of 0 .. total - 1 that were not delivered."""
    wanted = docs.select(doc, F.explode(page_range(F.col(total))).alias(shard)).withColumn(shard, F.col(shard).cast("long"))
    return wanted.join(deliveries.select(F.col(doc), F.col(shard).cast("long").alias(shard)), [doc, shard], "left_anti")


def winner(deliveries: DataFrame, totals: DataFrame, doc: str, shard: str, order: list[Column], total: str) -> DataFrame:
    """The delivery that completes each document: with distinct shards counted
    in ``order``, the one that brings the count to ``total``.  Exactly one row
    for a complete document, none for others.  The first delivery of a shard is
    an aggregate; the count ranks distinct shards only."""
    from docquarry.operators.ledger import first_per_key, winner_order

    counted = winner_order(first_per_key(deliveries, [doc, shard], order), [doc], order).drop("won")
    return counted.join(totals, doc).where(F.col("attempt") == F.col(total)).drop("attempt")


def assemble(pages: DataFrame, doc: str, number: str, text: str) -> DataFrame:
    """``doc``, ``source_text`` (pages in order, newline between), ``n_pages``
    and ``pages`` (the set of numbers)."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(number).alias("n"), F.col(text).alias("t"))))
    return pages.groupBy(doc).agg(ordered.alias("_p"), F.collect_set(number).alias("pages")).select(
        doc,
        F.array_join(F.transform("_p", lambda p: F.coalesce(p["t"], F.lit(""))), "\n").alias("source_text"),
        F.size("_p").cast("long").alias("n_pages"),
        F.array_sort("pages").alias("pages"),
    )


def first_missing(docs: DataFrame, outputs: DataFrame, doc: str, shard: str, total: str) -> DataFrame:
    """The least missing shard output of each document that lacks one."""
    return missing(docs, outputs, doc, shard, total).groupBy(doc).agg(F.min(shard).alias("shard_idx"))
