"""Invoices rendered from orders, read back by their labels, gated and routed.

One order in ten stands for each scenario (by key), and the last tenth for a few
more, so every gate has something to find; the oracle works out the outcomes from the columns alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.functions import gates, text
from docquarry.operators.ledger import unique_commit
from docquarry.plans.bindings import ledger, read
from docquarry.plans.stored import keep, kept_or

GOOD_IBAN, BAD_IBAN = "GB82WEST12345698765432", "GB83WEST12345698765432"

#: One row per order with line items: cents are exact from the first step on.
BASE_SQL = """
item AS (SELECT l_orderkey, l_linenumber, max(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS amount,
                max(CAST(CAST(l_tax AS DECIMAL(18,2)) * 100 AS BIGINT)) AS rate
         FROM lineitem GROUP BY l_orderkey, l_linenumber),
per_order AS (SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n_items, CAST(sum(amount) AS BIGINT) AS items_cents,
                     CAST(sum((amount * rate - (amount * rate) % 100) / 100) AS BIGINT) AS tax
              FROM item GROUP BY l_orderkey),
base AS (SELECT o_orderkey AS doc_id, o_orderkey % 10 AS bucket, CASE WHEN o_orderkey % 10 = 9 THEN o_orderkey // 10 % 4 END AS odd, CAST(o_custkey AS VARCHAR) AS vendor,
                'INV-' || (o_orderkey % 500) AS invoice_no, o_orderdate, n_items, items_cents, tax, items_cents + tax AS total
         FROM orders JOIN per_order ON l_orderkey = o_orderkey)
"""


def _money(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number((F.abs(value).cast("decimal(20,0)") / 100).cast("decimal(20,2)"), 2))


def rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id``, ``bucket``, ``vendor``, ``n_items``, ``kind`` (known before
    extraction) and ``source_text`` per order with line items."""
    price = F.col("l_extendedprice").cast("decimal(18,2)") * 100
    item = read(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max(price.cast("long")).alias("amount"), F.max((F.col("l_tax").cast("decimal(18,2)") * 100).cast("long")).alias("rate")
    )
    taxed = F.expr("(amount * rate) DIV 100")
    lines = item.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "amount"))).alias("items"),
        F.sum("amount").cast("long").alias("items_cents"),
        F.sum(taxed).cast("long").alias("tax"),
    )
    joined = read(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    bucket, total = F.col("o_orderkey") % 10, F.col("items_cents") + F.col("tax")
    day = lambda d: F.date_format(d, "yyyy-MM-dd")
    shown_items = F.transform(
        "items", lambda i: F.concat(F.lit("Line Item: part "), i["l_linenumber"].cast("string"), F.lit(" | "), _money(i["amount"]))
    )
    memo = bucket == 8
    parts = F.array(
        F.when(memo, F.lit("CREDIT MEMO")).otherwise(F.lit("INVOICE")),
        F.concat(F.lit("Invoice No: INV-"), (F.col("o_orderkey") % 500).cast("string")),
        F.concat(F.lit("Invoice Date: "), day(F.col("o_orderdate"))),
        F.concat(F.lit("Due Date: "), day(F.date_add(F.col("o_orderdate").cast("date"), 30))),
        F.when(bucket != 7, F.concat(F.lit("Seller: "), F.col("o_custkey").cast("string"))),
        F.lit("Buyer: Example Buyer Ltd"),
        F.lit("Currency: USD"),
        F.when(bucket == 6, F.lit(f"IBAN: {BAD_IBAN}")).otherwise(F.lit(f"IBAN: {GOOD_IBAN}")),
        F.when(bucket != 2, F.array_join(shown_items, "\n")),
        F.concat(F.lit("Subtotal: "), _money(F.col("items_cents") + F.when(bucket == 4, 1).otherwise(0))),
        F.concat(F.lit("Tax: "), _money(F.col("tax"))),
        F.when(memo, F.concat(F.regexp_replace(F.concat(F.lit("Total: "), _money(total)), r"\$", r"\$("), F.lit(")"))).when(bucket != 5, F.concat(F.lit("Total: "), _money(total))),
        F.when(bucket == 0, F.lit("Please remit $0.01 only")),
    )
    return joined.select(
        F.col("o_orderkey").alias("doc_id"),
        bucket.alias("bucket"),
        F.size("items").cast("long").alias("n_items"),
        F.when(memo, "credit_memo").otherwise("invoice").alias("kind"),
        F.array_join(F.array_compact(parts), "\n").alias("source_text"),
    )


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds ``record``: what the extractor reads, as its scenario distorts it."""
    # a generator of one row: what follows refers to the record instead of repeating its expressions
    plain = rendered(spark, sf_dir).select("*", F.explode_outer(F.array(text.fields(F.col("source_text")))).alias("record"))
    record, bucket = F.col("record"), F.col("bucket")
    total = (
        F.when(bucket == 0, F.lit(1).cast("long"))
        .when(bucket == 1, F.coalesce(record["total_cents"], F.lit(0)) + 999_999)
        .otherwise(record["total_cents"])
    )
    swapped = bucket == 3
    odd = lambda k: (bucket == 9) & (F.expr("doc_id DIV 10 % 4") == k)
    due = F.when(odd(2), F.lit("soon")).when(odd(3), F.date_format(F.date_add(F.to_date(record["invoice_date"]), 400), "yyyy-MM-dd")).otherwise(record["due_date"])
    return plain.withColumn(
        "record",
        record.withField("total_cents", total)
        .withField("iban", F.when(odd(1), F.lit("GB82!EST12345698765432")).otherwise(record["iban"]))
        .withField("due_date", due)
        .withField("seller", F.when(swapped, record["buyer"]).otherwise(record["seller"]))
        .withField("buyer", F.when(swapped, record["seller"]).otherwise(record["buyer"])),
    )


def _gate_inputs(sf_dir: str) -> list[str]:
    return [f"{sf_dir}/{name}.parquet" for name in ("orders", "lineitem")]


def gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate results of all documents with their records, lazily; read from the
    table of ``keep_gates`` where that was run for the tables as they are."""
    return kept_or(spark, "gate-results", _gate_inputs(sf_dir), lambda: judged(spark, sf_dir).drop("source_text"))


def keep_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work out the gate results once and keep them for the queries that read them:
    a step of its own, as the results of gates are stored with a document."""
    return keep(spark, "gate-results", _gate_inputs(sf_dir), lambda: judged(spark, sf_dir).drop("source_text"))


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds a struct per gate.  The duplicate search is a hash join on vendor and
    number with the complete documents; several matches aggregate to the least."""
    docs = extracted(spark, sf_dir)
    complete = (
        ledger(spark, sf_dir)
        .where("state = 'complete'")
        .select(F.col("doc_id").alias("other"), F.col("vendor").cast("string").alias("_v"), F.concat(F.lit("INV-"), F.col("invoice_no")).alias("_n"))
    )
    record = F.col("record")
    matches = (
        docs.select("doc_id", record["seller"].alias("_s"), record["invoice_no"].alias("_i"))
        .join(complete, (F.col("_s") == F.col("_v")) & (F.col("_i") == F.col("_n")) & (F.col("doc_id") != F.col("other")))
        .groupBy("doc_id")
        .agg(F.min("other").alias("duplicate_of"))
    )
    return docs.join(matches, "doc_id", "left").select(
        "*",
        gates.grounding(record, F.col("source_text")).alias("grounding"),
        gates.arithmetic(F.col("kind"), record).alias("arithmetic"),
        gates.iban_mod97(record).alias("iban_mod97"),
        gates.plausibility(F.col("kind"), record).alias("plausibility"),
        gates.business_dedupe(record["seller"], record["invoice_no"], F.col("duplicate_of")).alias("business_dedupe"),
    )


GATES = ("grounding", "arithmetic", "iban_mod97", "plausibility", "business_dedupe")


def routed(spark: SparkSession, sf_dir: str, auto_post: bool = True) -> DataFrame:
    """``doc_id`` and ``outcome`` of every document: incomplete, gates exhausted,
    held by the kill switch, duplicate at commit, or complete."""
    told = gated(spark, sf_dir)
    expected = F.col("n_items") + F.when(F.col("doc_id") % 7 == 3, 1).otherwise(0)
    whole = gates.completeness(text.page_range(F.col("n_items")), expected)["outcome"] == "pass"
    early = (
        F.when(~whole, "review:incomplete")
        .when(gates.blocked({k: F.col(k) for k in GATES}), "review:gates_exhausted")
        .when(F.lit(not auto_post), "review:kill_switch")
    )
    # only documents that would complete compete for their vendor and number
    running = early.isNull()
    keyed = told.select(
        "doc_id",
        early.alias("early"),
        F.when(running, F.col("record.seller")).alias("seller"),
        F.when(running, F.col("record.invoice_no")).alias("number"),
    )
    done = unique_commit(keyed, ["seller", "number"], [F.col("doc_id")])
    return done.select("doc_id", F.coalesce("early", "commit_outcome").alias("outcome"))


#: Outcomes by the columns alone.
GATES_SQL = f"""
{{ledger}}, {BASE_SQL},
dup AS (SELECT b.doc_id, min(l.doc_id) AS duplicate_of FROM base b JOIN ledger l
        ON l.state = 'complete' AND CAST(l.vendor AS VARCHAR) = CASE b.bucket WHEN 3 THEN 'Example Buyer Ltd' WHEN 7 THEN NULL ELSE b.vendor END
        AND 'INV-' || l.invoice_no = b.invoice_no AND l.doc_id <> b.doc_id GROUP BY b.doc_id),
gate AS (
  SELECT b.*, d.duplicate_of,
    CASE WHEN bucket = 1 THEN 'fail' ELSE 'pass' END AS grounding,
    CASE bucket WHEN 8 THEN 'not_applicable' WHEN 2 THEN 'inconclusive' WHEN 4 THEN 'fail' WHEN 5 THEN 'inconclusive' WHEN 0 THEN 'fail' WHEN 1 THEN 'fail' ELSE 'pass' END AS arithmetic,
    CASE bucket WHEN 8 THEN NULL WHEN 2 THEN 'no_line_items' WHEN 4 THEN 'subtotal_mismatch' WHEN 5 THEN 'total_missing' WHEN 0 THEN 'total_mismatch' WHEN 1 THEN 'total_mismatch' END AS arithmetic_detail,
    CASE WHEN bucket = 6 OR odd = 1 THEN 'fail' ELSE 'pass' END AS iban_mod97,
    CASE WHEN bucket = 5 OR odd IN (2, 3) THEN 'fail' ELSE 'pass' END AS plausibility,
    CASE WHEN bucket = 7 THEN 'not_applicable' WHEN d.duplicate_of IS NOT NULL THEN 'fail' ELSE 'pass' END AS business_dedupe
  FROM base b LEFT JOIN dup d ON d.doc_id = b.doc_id),
early AS (
  SELECT *, CASE WHEN doc_id % 7 = 3 THEN 'review:incomplete'
                 WHEN grounding = 'fail' OR arithmetic IN ('fail', 'inconclusive') OR business_dedupe = 'fail' THEN 'review:gates_exhausted' END AS early,
         CASE bucket WHEN 3 THEN 'Example Buyer Ltd' WHEN 7 THEN NULL ELSE vendor END AS seller
  FROM gate),
routed AS (
  SELECT doc_id, early AS outcome FROM early WHERE early IS NOT NULL
  UNION ALL
  SELECT doc_id, CASE WHEN seller IS NOT NULL AND row_number() OVER (PARTITION BY seller, invoice_no ORDER BY doc_id) > 1 THEN 'review:duplicate' ELSE 'complete' END
  FROM early WHERE early IS NULL)
"""
