"""The end of a document: each request to finalise it has exactly one outcome."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.operators.ledger import winner_order


def finalise(requests: DataFrame, known: DataFrame, missing: DataFrame, judged: DataFrame) -> DataFrame:
    """``doc_id``, ``seq``, ``outcome``, ``shard_idx`` and ``diverged`` per request.

    ``requests`` has ``doc_id``, ``seq`` and ``result``, and is delivered at least
    once; ``known`` the doc_ids of the ledger; ``missing`` the first ``shard_idx``
    without output of documents that lack one; ``judged`` the ``outcome`` of gates
    and commit.  A document that the ledger does not know, or whose shards are
    not all there, is never judged.  Of several requests that would complete a
    document the first writes; the others are discarded, and ``diverged`` tells
    whether their result is another.
    """
    own = known.select("doc_id", F.lit(True).alias("_known")).distinct()
    told = requests.join(own, "doc_id", "left").join(missing.select("doc_id", "shard_idx"), "doc_id", "left").join(judged.select("doc_id", F.col("outcome").alias("_judged")), "doc_id", "left")
    early = F.when(F.col("_known").isNull(), "unknown_doc").when(F.col("shard_idx").isNotNull(), "review:shard_output_missing")
    ranked = winner_order(told.withColumn("_early", F.coalesce(early, F.when(F.col("_judged") != "complete", F.col("_judged")))), ["doc_id"], [F.col("seq")])
    first = ranked.where("won").select("doc_id", F.col("result").alias("_committed"))
    late = F.col("_early").isNull() & ~F.col("won")
    return ranked.join(first, "doc_id").select(
        "doc_id",
        "seq",
        F.coalesce("_early", F.when(late, F.lit("discarded:not_first_writer")).otherwise("complete")).alias("outcome"),
        F.when(F.col("_known"), F.col("shard_idx")).cast("int").alias("shard_idx"),
        (late & ~F.col("result").eqNullSafe(F.col("_committed"))).alias("diverged"),
    )
