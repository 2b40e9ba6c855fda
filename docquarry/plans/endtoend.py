"""From uploads to final states in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry.functions import gates, text
from docquarry.operators.ledger import first_per_key, unique_commit
from docquarry.operators.shards import assemble
from docquarry.plans.triage import ocr_lookup, sanity, triage

FLOOR = 15.0


def process(objects: DataFrame, pages: DataFrame, by_page: DataFrame, by_image: DataFrame, complete: DataFrame | None = None, page_ceiling: int = 20) -> DataFrame:
    """``doc_id``, ``state`` and ``reason`` of every upload.

    ``objects`` as for triage; ``pages`` has ``doc_id``, ``page_no``, ``text``
    (the embedded layer, perhaps empty) and ``image``; ``complete`` holds
    ``vendor`` and ``invoice_no`` of what is complete already.  A document whose
    embedded text passes the text check keeps it, any other takes recognised
    text.  Of documents with one vendor and number the least doc_id completes.
    """
    spark = objects.sparkSession
    told = triage(objects, page_ceiling)
    running = told.where("result = 'dispatched'").select("doc_id", "page_count")
    own = pages.join(running.select("doc_id"), "doc_id", "left_semi")
    checked = sanity(own, FLOOR).select("doc_id", "sane")
    sample = assemble(own.where("page_no < 3"), "doc_id", "page_no", "text").select(
        "doc_id", text.has_text_layer(F.col("source_text")).alias("layer"), text.doc_type(F.col("source_text")).alias("kind")
    )
    facts = checked.join(sample, "doc_id", "left").select("doc_id", F.coalesce(F.col("sane") & F.col("layer"), F.lit(False)).alias("embedded"), F.coalesce("kind", F.lit("invoice")).alias("kind"))
    read = ocr_lookup(own, by_page, by_image).select("doc_id", "page_no", F.col("text").alias("seen"))
    chosen = own.join(read, ["doc_id", "page_no"]).join(facts, "doc_id").select("doc_id", "page_no", F.when(F.col("embedded"), F.col("text")).otherwise(F.col("seen")).alias("text"))
    made = assemble(chosen, "doc_id", "page_no", "text").join(running, "doc_id").join(facts.select("doc_id", "kind"), "doc_id")
    recorded = made.select("*", F.explode_outer(F.array(text.fields(F.col("source_text")))).alias("record"))
    known = (spark.createDataFrame([], "vendor string, invoice_no string") if complete is None else complete).select("vendor", "invoice_no", F.lit("earlier").alias("other"))
    known = first_per_key(known, ["vendor", "invoice_no"], [F.col("other")])
    record = F.col("record")
    matched = recorded.join(known, (record["seller"] == F.col("vendor")) & (record["invoice_no"] == F.col("invoice_no")), "left")
    judged = {
        "grounding": gates.grounding(record, F.col("source_text")),
        "arithmetic": gates.arithmetic(F.col("kind"), record),
        "business_dedupe": gates.business_dedupe(record["seller"], record["invoice_no"], F.col("other")),
    }
    whole = gates.completeness(F.col("pages"), F.col("page_count"))["outcome"] == "pass"
    early = F.when(~whole, "incomplete").when(gates.blocked(judged), "gates_exhausted")
    keyed = matched.select(
        "doc_id", early.alias("early"), F.when(early.isNull(), record["seller"]).alias("seller"), F.when(early.isNull(), record["invoice_no"]).alias("number")
    )
    done = unique_commit(keyed, ["seller", "number"], [F.col("doc_id")]).select(
        "doc_id", F.coalesce("early", F.when(F.col("commit_outcome") != "complete", "duplicate")).alias("stopped")
    )
    state = F.when(F.col("result") != "dispatched", F.col("state")).when(F.col("stopped").isNull(), "complete").otherwise("review")
    return told.join(done, "doc_id", "left").select("doc_id", state.alias("state"), F.coalesce("last_error", "stopped").alias("reason"))
