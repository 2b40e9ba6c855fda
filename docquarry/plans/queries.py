"""The query catalogue: a DataFrame and DuckDB text for each operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.functions import gates, replies, states, text
from docquarry.operators import finalise as ends
from docquarry.operators import funnel, recon, shards
from docquarry.operators import ledger as ops
from docquarry.plans import bindings as b
from docquarry.plans import invoices

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


AS_OF, EV = f"TIMESTAMP '{b.AS_OF}'", f"TIMESTAMP '{b.EVENTS_AS_OF}'"
_TOTALS = "totals AS (SELECT l_orderkey AS doc_id, CAST(max(l_linenumber) AS BIGINT) AS shards_total FROM lineitem GROUP BY 1)"


def _totals(spark, sf_dir) -> DataFrame:
    return b.read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.max("l_linenumber").cast("long").alias("shards_total"))


def _with_totals(spark, sf_dir) -> DataFrame:
    docs = b.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"))
    return docs.join(_totals(spark, sf_dir), "doc_id", "left").select("doc_id", F.coalesce("shards_total", F.lit(0)).cast("long").alias("shards_total"))


# ---- core relational --------------------------------------------------------


@query(
    f"""WITH {_TOTALS}, done AS (SELECT l_orderkey AS doc_id, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY 1)
SELECT o_orderkey AS doc_id, coalesce(t.shards_total, 0)::BIGINT AS shards_total, coalesce(d.n, 0)::BIGINT AS shards_done,
       (coalesce(t.shards_total, 0) - coalesce(d.n, 0))::BIGINT AS missing, coalesce(d.n, 0) = coalesce(t.shards_total, 0) AS complete
FROM orders LEFT JOIN totals t ON t.doc_id = o_orderkey LEFT JOIN done d ON d.doc_id = o_orderkey"""
)
def scatter_gather_complete(spark, sf_dir):
    return shards.completion(_with_totals(spark, sf_dir), b.deliveries(spark, sf_dir), "doc_id", "shard_idx", "shards_total")


@query("SELECT DISTINCT l_orderkey AS doc_id, CAST(l_linenumber - 1 AS INT) AS shard_idx FROM lineitem")
def shard_claim_dedupe(spark, sf_dir):
    return shards.claims(b.deliveries(spark, sf_dir), "doc_id", "shard_idx")


@query(
    f"""WITH {_TOTALS} SELECT t.doc_id, r.i::BIGINT AS shard_idx FROM totals t, range(0, 8) r(i)
WHERE r.i < t.shards_total AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = t.doc_id AND l_linenumber - 1 = r.i)"""
)
def missing_shards(spark, sf_dir):
    return shards.missing(_totals(spark, sf_dir), b.deliveries(spark, sf_dir), "doc_id", "shard_idx", "shards_total")


@query(
    f"""WITH {_TOTALS} SELECT t.doc_id, CAST(min(r.i) AS BIGINT) AS shard_idx FROM totals t, range(0, 8) r(i)
WHERE r.i < t.shards_total AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = t.doc_id AND l_linenumber - 1 = r.i) GROUP BY 1"""
)
def shard_output_missing(spark, sf_dir):
    return shards.first_missing(_totals(spark, sf_dir), b.deliveries(spark, sf_dir), "doc_id", "shard_idx", "shards_total")


_WINNER = "l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_returnflag, l_linestatus"


@query(
    f"""WITH {_TOTALS}, firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_WINNER}) AS r FROM lineitem) WHERE r = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_WINNER}, l_linenumber) AS n FROM firsts)
SELECT doc_id, CAST(l_linenumber - 1 AS INT) AS shard_idx, l_shipdate AS won_at, shards_total FROM ranked JOIN totals ON doc_id = l_orderkey WHERE n = shards_total"""
)
def scatter_gather_winner(spark, sf_dir):
    rows = b.read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), (F.col("l_linenumber") - 1).cast("int").alias("shard_idx"), *[F.col(c.strip()) for c in _WINNER.split(",")]
    )
    order = [F.col(c.strip()) for c in _WINNER.split(",")] + [F.col("shard_idx")]
    won = shards.winner(rows, _totals(spark, sf_dir), "doc_id", "shard_idx", order, "shards_total")
    return won.select("doc_id", "shard_idx", F.col("l_shipdate").alias("won_at"), "shards_total")


@query("SELECT md5(text) AS content_id, CAST(min(doc_id) AS BIGINT) AS doc_id FROM documents GROUP BY 1")
def content_dedupe(spark, sf_dir):
    rows = b.read(spark, sf_dir, "documents").select(F.md5("text").alias("content_id"), "doc_id")
    return ops.first_per_key(rows, ["content_id"], [F.col("doc_id")])


@query(
    """SELECT user_id AS doc_id, event_id AS seq, 'auto_post' AS route FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r
FROM events WHERE event_type = 'purchase') WHERE r = 1 AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup' AND event_id % 4 = 0)"""
)
def sink_idempotent(spark, sf_dir):
    events = b.read(spark, sf_dir, "events")
    posted = events.where("event_type = 'signup' AND event_id % 4 = 0").select(F.col("user_id").alias("doc_id"))
    batch = events.where("event_type = 'purchase'").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("seq"), F.lit("auto_post").alias("route"))
    return ops.insert_if_absent(batch, posted, ["doc_id"], [F.col("seq")]).select("doc_id", "seq", "route")


@query(
    """SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
AND doc_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup')"""
)
def orphan_detect(spark, sf_dir):
    pending = b.outbox(spark, sf_dir).where("topic = 'triage.requests'").select("doc_id")
    return recon.orphans(b.read(spark, sf_dir, "documents").select("doc_id"), b.read(spark, sf_dir, "labels"), pending, "doc_id")


@query("SELECT conv_id AS doc_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn, text) AS source_text, count(*)::BIGINT AS n_pages FROM conversations GROUP BY 1")
def assemble_pages(spark, sf_dir):
    return shards.assemble(b.pages(spark, sf_dir), "doc_id", "page_no", "text").select("doc_id", "source_text", "n_pages")


@query(
    f"""WITH {b.DELIVERIES_SQL}, seen AS (SELECT doc_id, list_sort(list(DISTINCT shard_idx)) AS p, CAST(max(shard_idx) + 1 + doc_id % 2 AS INT) AS n FROM deliveries GROUP BY doc_id),
cmp AS (SELECT doc_id, list_filter(range(0, n), lambda x: NOT list_contains(p, x)) AS missing, list_filter(p, lambda x: x >= n) AS extra FROM seen)
SELECT doc_id, CASE WHEN len(missing) > 0 OR len(extra) > 0 THEN 'fail' ELSE 'pass' END AS outcome,
  CASE WHEN len(missing) > 0 OR len(extra) > 0 THEN 'missing=' || coalesce(array_to_string(missing, ','), '') || ';unexpected=' || coalesce(array_to_string(extra, ','), '') END AS detail FROM cmp"""
)
def completeness_gate(spark, sf_dir):
    seen = b.deliveries(spark, sf_dir).groupBy("doc_id").agg(F.collect_set("shard_idx").alias("pages"), F.max("shard_idx").alias("top"))
    expected = (F.col("top") + 1 + F.col("doc_id") % 2).cast("int")
    return seen.select("doc_id", gates.completeness(F.col("pages"), expected).alias("g")).select("doc_id", "g.*")


# ---- triage and text --------------------------------------------------------

_SIX = ["zero_byte", "unsupported_mime", "encrypted", "corrupt", "page_ceiling"]
_TRIAGE_SQL = f"""
{b.OBJECTS_SQL},
told AS (SELECT *, coalesce(content_type, 'application/octet-stream') AS mime,
  CASE WHEN size = 0 THEN 'zero_byte'
       WHEN coalesce(content_type, 'application/octet-stream') NOT IN ('application/pdf', 'image/jpeg', 'image/png', 'image/tiff') THEN 'unsupported_mime'
       WHEN encrypted THEN 'encrypted' WHEN corrupt THEN 'corrupt' WHEN page_count > 20 THEN 'page_ceiling' END AS rejected
  FROM objects),
triaged AS (SELECT *, CASE WHEN rejected IS NOT NULL THEN rejected
       WHEN row_number() OVER (PARTITION BY content_id ORDER BY doc_id) > 1 THEN 'duplicate' ELSE 'dispatched' END AS result FROM told)"""


def _triaged(spark, sf_dir) -> DataFrame:
    from docquarry.plans.triage import triage

    return triage(b.objects(spark, sf_dir))


@query(
    f"""WITH {_TRIAGE_SQL} SELECT doc_id, result,
CASE WHEN result IN ('zero_byte', 'unsupported_mime') THEN 'failed' WHEN result IN ('encrypted', 'corrupt', 'page_ceiling') THEN 'review' WHEN result = 'dispatched' THEN 'text_pending' END AS state,
CASE result WHEN 'zero_byte' THEN 'zero_byte_object' WHEN 'unsupported_mime' THEN 'unsupported_mime:' || mime WHEN 'encrypted' THEN 'encrypted_pdf'
  WHEN 'corrupt' THEN 'corrupt_pdf:unreadable' WHEN 'page_ceiling' THEN 'page_ceiling_exceeded:' || page_count END AS last_error FROM triaged"""
)
def triage_classify(spark, sf_dir):
    return _triaged(spark, sf_dir).select("doc_id", "result", "state", "last_error")


@query(f"WITH {_TRIAGE_SQL} SELECT result, count(*)::BIGINT AS n FROM triaged GROUP BY 1")
def triage_metrics(spark, sf_dir):
    return _triaged(spark, sf_dir).groupBy("result").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {_TRIAGE_SQL}, firsts AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS s FROM conversations WHERE turn < 3 GROUP BY 1),
hint AS (SELECT t.*, coalesce(length(trim(s)) >= 5 AND regexp_matches(s, '[0-9]'), false) AS layer FROM triaged t LEFT JOIN firsts ON conv_id = doc_id WHERE result = 'dispatched'),
t AS (SELECT *, CASE WHEN layer THEN 'text.embedded' WHEN page_count <= 4 THEN 'ocr.shard' ELSE 'ocr.split' END AS topic FROM hint)
SELECT doc_id, topic, CASE WHEN topic = 'ocr.shard' THEN 0 END AS shard_idx, CASE WHEN topic = 'ocr.shard' THEN page_count END AS page_end, gcs_path AS path FROM t"""
)
def route_text_production(spark, sf_dir):
    from docquarry.plans.triage import dispatch

    first_pages = shards.assemble(b.pages(spark, sf_dir).where("page_no < 3"), "doc_id", "page_no", "text")
    return dispatch(_triaged(spark, sf_dir), first_pages.select("doc_id", F.col("source_text").alias("sample")), shard_size=4)


@query(
    """SELECT doc_id, CAST(i AS INT) AS shard_idx, n AS shards_total, CAST(i * 4 AS INT) AS page_start, CAST(least((i + 1) * 4, pages) AS INT) AS page_end
FROM (SELECT doc_id, CAST(n_chars // 400 + 1 AS INT) AS pages, CAST(greatest(1, ceil((n_chars // 400 + 1) / 4)) AS INT) AS n FROM documents), LATERAL (SELECT unnest(range(0, n)) AS i)"""
)
def split_shards(spark, sf_dir):
    docs = b.objects(spark, sf_dir).select("doc_id", "page_count")
    return shards.split(docs, "page_count", 4).select("doc_id", "shard_idx", "shards_total", "page_start", "page_end")


@query(
    """SELECT conv_id AS doc_id, coalesce(length(trim(s)) >= 5 AND regexp_matches(s, '[0-9]'), false) AS has_text_layer
FROM (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS s FROM conversations WHERE turn < 3 GROUP BY 1)"""
)
def text_layer_hint(spark, sf_dir):
    sample = shards.assemble(b.pages(spark, sf_dir).where("page_no < 3"), "doc_id", "page_no", "text")
    return sample.select("doc_id", text.has_text_layer(F.col("source_text")).alias("has_text_layer"))


@query(
    """SELECT doc_id, CASE WHEN n = 0 THEN 'no_pages' WHEN d < 300 THEN 'token_density_' || printf('%.1f', d) || '_below_floor' WHEN NOT digit THEN 'no_digits_present' ELSE 'ok' END AS reason, d >= 300 AND digit AS sane
FROM (SELECT conv_id AS doc_id, count(text) AS n, sum(length(trim(text))) / count(text)::DOUBLE AS d, bool_or(regexp_matches(text, '[0-9]')) AS digit FROM conversations GROUP BY 1)"""
)
def text_sanity(spark, sf_dir):
    from docquarry.plans.triage import sanity

    return sanity(b.pages(spark, sf_dir), floor=300)


@query(
    """SELECT doc_id, CASE WHEN contains(lower(text), 'that') THEN 'credit_memo' WHEN contains(lower(text), 'les ') THEN 'receipt' ELSE 'invoice' END AS kind FROM documents"""
)
def classify_doc_type(spark, sf_dir):
    """The tables hold no invoices, so two frequent words stand for the keywords."""
    docs = b.read(spark, sf_dir, "documents")
    worded = F.replace(F.replace(F.lower("text"), F.lit("that"), F.lit("credit memo")), F.lit("les "), F.lit("receipt"))
    return docs.select("doc_id", text.doc_type(worded).alias("kind"))


@query(
    """SELECT conv_id AS doc_id, turn::INT AS page_no, coalesce(r1.text, r2.text, c.text) AS text,
CASE WHEN r1.item_id IS NOT NULL OR r2.item_id IS NOT NULL THEN 0.95 ELSE 0.5 END::DOUBLE AS confidence
FROM conversations c LEFT JOIN benchmark r1 ON r1.item_id = c.conv_id * 8 + c.turn LEFT JOIN benchmark r2 ON md5(r2.item_id::VARCHAR) = md5((c.conv_id % 60)::VARCHAR)"""
)
def ocr_registry_lookup(spark, sf_dir):
    from docquarry.plans.triage import ocr_lookup

    bench = b.read(spark, sf_dir, "benchmark")
    by_page = bench.select((F.expr("item_id DIV 8")).alias("doc_id"), (F.col("item_id") % 8).cast("int").alias("page_no"), "text", F.lit(0.95).alias("confidence"))
    by_image = bench.select(F.md5(F.col("item_id").cast("string")).alias("image"), "text", F.lit(0.95).alias("confidence"))
    pages = b.pages(spark, sf_dir).withColumn("image", F.md5((F.col("doc_id") % 60).cast("string")))
    return ocr_lookup(pages, by_page, by_image)


@query("SELECT doc_id, 'inbox' AS bucket, 'upload-' || doc_id || '.pdf' AS object_key, 'ocr/' || doc_id || '.json' AS assembled, 'shards/' || doc_id || '/' || lpad((doc_id % 12)::VARCHAR, 4, '0') || '.pdf' AS shard FROM documents")
def object_paths(spark, sf_dir):
    path = F.col("gcs_path")
    return b.objects(spark, sf_dir).select(
        "doc_id", text.bucket_of(path).alias("bucket"), text.key_of(path).alias("object_key"), text.assembled_path(F.col("doc_id")).alias("assembled"),
        text.shard_path(F.col("doc_id"), F.col("doc_id") % 12).alias("shard"),
    )


# ---- extraction and gates ---------------------------------------------------

GATES_SQL = invoices.GATES_SQL.replace("{ledger}", b.LEDGER_SQL)


@query(
    f"""WITH {invoices.BASE_SQL} SELECT doc_id, CASE WHEN bucket = 8 THEN 'credit_memo' ELSE 'invoice' END AS kind, invoice_no,
strftime(o_orderdate, '%Y-%m-%d') AS invoice_date, strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%d') AS due_date,
CASE WHEN bucket = 7 THEN NULL ELSE vendor END AS seller, 'Example Buyer Ltd' AS buyer, 'USD' AS currency,
CASE WHEN bucket = 6 THEN '{invoices.BAD_IBAN}' ELSE '{invoices.GOOD_IBAN}' END AS iban,
CASE bucket WHEN 5 THEN NULL WHEN 8 THEN -total ELSE total END AS total_cents, items_cents + CASE WHEN bucket = 4 THEN 1 ELSE 0 END AS subtotal_cents, tax AS tax_cents FROM base"""
)
def render_extract_fields(spark, sf_dir):
    r = text.fields(F.col("source_text"))
    names = ["invoice_no", "invoice_date", "due_date", "seller", "buyer", "currency", "iban", "total_cents", "subtotal_cents", "tax_cents"]
    return invoices.rendered(spark, sf_dir).select("doc_id", r.alias("r")).select("doc_id", F.col("r.doc_type").alias("kind"), *[F.col(f"r.{n}") for n in names])


@query(f"WITH {invoices.BASE_SQL} SELECT doc_id, 'part ' || l_linenumber AS description, amount AS amount_cents FROM base JOIN item ON l_orderkey = doc_id WHERE bucket <> 2")
def extract_line_items(spark, sf_dir):
    items = invoices.rendered(spark, sf_dir).select("doc_id", F.explode(text.line_items(F.col("source_text"))).alias("i"))
    return items.select("doc_id", "i.description", "i.amount_cents")


def _reply(doc_type="\"invoice\"", total="' || (o_orderkey * 7) || '", currency="\"USD\"", seller="\"v' || o_custkey || '\"", items="[{\"description\": \"a\", \"amount_cents\": 3}]") -> str:
    return f"""'{{"doc_type": {doc_type}, "invoice_no": "INV-' || (o_orderkey % 500) || '", "currency": {currency}, "seller": {seller}, "total_cents": {total}, "line_items": {items}, "note": null}}'"""


_BAD_ITEM = '[{"description": "a", "amount_cents": 3}, {"amount_cents": 4}, {"description": "b", "amount_cents": "x"}, 5]'
#: What a model might reply, by order; one text for both engines.
_REPLIES = [
    f"'Sure:' || chr(10) || '```json' || chr(10) || {_reply()} || chr(10) || '```' || chr(10) || 'Is {{that}} all?'",
    f"'Here it is: ' || {_reply(doc_type=chr(34) + 'credit_memo' + chr(34))} || ' as asked.'",
    "'  '",
    "'I cannot find any fields in document ' || o_orderkey || repeat(' and I am sorry', 60)",
    "'{\"invoice_no\": \"A' || o_orderkey || '\", \"total_cents\": }'",
    _reply(total="\"' || (o_orderkey * 7) || '\""),
    _reply(total="' || o_orderkey || '.5"),
    _reply(currency="null"),
    _reply(doc_type='"letter"'),
    _reply(items=_BAD_ITEM),
    _reply(seller="' || o_custkey || '"),
    _reply(total='"abc"', items='{"a": 1}'),
    _reply(total="true", items="null"),
    "'{}'",
]
_RAW = "CASE o_orderkey % 14 " + " ".join(f"WHEN {k} THEN {r}" for k, r in enumerate(_REPLIES)) + " END"


def _replies(spark, sf_dir) -> DataFrame:
    return b.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"), F.expr(_RAW.replace("\\", "\\\\")).alias("raw"))


_PARSED_SQL = f"""replies AS (SELECT o_orderkey AS doc_id, o_orderkey % 14 AS bucket, {_RAW} AS raw FROM orders),
cut AS (SELECT *, regexp_extract(raw, '{replies.FENCED}', 1) AS fenced FROM replies),
braced AS (SELECT *, regexp_extract(CASE WHEN fenced <> '' THEN fenced ELSE raw END, '{replies.BRACED}', 0) AS j FROM cut),
parsed AS (SELECT doc_id, bucket, CASE WHEN trim(raw) = '' THEN 'refusal' WHEN j = '' OR NOT json_valid(j) THEN 'unparseable' ELSE 'ok' END AS kind,
  CASE WHEN trim(raw) = '' THEN 'empty completion' WHEN j = '' THEN left(raw, 500) WHEN NOT json_valid(j) THEN 'invalid json: ' || left(raw, 500) END AS message,
  CASE WHEN j <> '' AND json_valid(j) THEN j END AS json FROM braced)"""


@query(f"WITH {_PARSED_SQL} SELECT doc_id, kind, message, json FROM parsed")
def parse_reply(spark, sf_dir):
    """The JSON of replies, fenced or between braces, and what is wrong with others."""
    return _replies(spark, sf_dir).select("doc_id", replies.parse_reply(F.col("raw")).alias("p")).select("doc_id", "p.*")


#: Errors and amounts follow from the shape of the reply alone.
_CHECKED_SQL = f"""{_PARSED_SQL},
checked AS (SELECT *, CASE bucket WHEN 6 THEN 'total_cents:int_from_float' WHEN 7 THEN 'currency:string_type' WHEN 8 THEN 'doc_type:literal_error'
  WHEN 9 THEN 'line_items.1.description:missing,line_items.2.amount_cents:int_parsing,line_items.3:model_type' WHEN 10 THEN 'seller:string_type'
  WHEN 11 THEN 'total_cents:int_parsing,line_items:list_type' ELSE '' END AS errors FROM parsed WHERE kind = 'ok')"""


@query(
    f"""WITH {_CHECKED_SQL} SELECT doc_id, CASE WHEN errors = '' THEN 'pass' ELSE 'fail' END AS outcome, errors,
CASE WHEN errors = '' THEN coalesce(json ->> 'doc_type', 'invoice') END AS kind, CASE WHEN errors = '' THEN 'USD' END AS currency,
CASE WHEN errors = '' THEN CASE bucket WHEN 13 THEN NULL WHEN 12 THEN 1 ELSE doc_id * 7 END END::BIGINT AS total_cents,
CASE WHEN errors = '' THEN CASE WHEN bucket IN (12, 13) THEN NULL ELSE 1 END END::INT AS n_items FROM checked"""
)
def schema_gate(spark, sf_dir):
    """The typed record of each reply that has one: lax about spelling, strict about kind."""
    parsed = _replies(spark, sf_dir).select("doc_id", replies.parse_reply(F.col("raw")).alias("p")).where("p.kind = 'ok'")
    told = parsed.select("doc_id", replies.validate(F.col("p.json")).alias("v"))
    record = F.col("v.record")
    return told.select(
        "doc_id", "v.outcome", "v.errors", record["doc_type"].alias("kind"), record["currency"].alias("currency"), record["total_cents"].alias("total_cents"),
        F.when(record["line_items"].isNotNull(), F.size(record["line_items"])).alias("n_items"),
    )


@query(
    f"""WITH {_CHECKED_SQL}, told AS (SELECT p.doc_id, p.kind, p.message, c.errors FROM parsed p LEFT JOIN checked c ON c.doc_id = p.doc_id)
SELECT doc_id, CASE WHEN kind = 'ok' AND errors <> '' THEN 'schema_invalid' ELSE kind END AS kind,
CASE WHEN kind = 'unparseable' THEN 'response was not valid JSON: ' || message WHEN errors <> '' THEN 'schema errors: ' || errors END AS hint FROM told"""
)
def repair_hints(spark, sf_dir):
    """What the funnel makes of each reply, and what the next attempt is told."""
    parsed = _replies(spark, sf_dir).select("doc_id", replies.parse_reply(F.col("raw")).alias("p"))
    told = parsed.select("doc_id", "p.kind", "p.message", replies.validate(F.col("p.json"))["errors"].alias("errors"))
    kind = F.when((F.col("kind") == "ok") & (F.col("errors") != ""), "schema_invalid").otherwise(F.col("kind"))
    return told.select("doc_id", kind.alias("kind"), replies.repair_hint(F.col("kind"), F.col("message"), F.col("errors")).alias("hint"))


@query(
    """WITH c AS (SELECT event_id, CASE event_id % 9 WHEN 0 THEN 'timeout' WHEN 1 THEN 'connect_error' END AS fault,
CASE event_id % 9 WHEN 2 THEN 429 WHEN 3 THEN 503 WHEN 4 THEN 400 WHEN 5 THEN 400 WHEN 6 THEN 404 ELSE 200 END AS status,
CASE event_id % 9 WHEN 4 THEN 'Maximum CONTEXT length exceeded by ' || event_id ELSE props END AS body FROM events),
k AS (SELECT *, CASE WHEN fault IS NOT NULL OR status = 429 OR status >= 500 THEN 'transient' WHEN status = 400 AND contains(lower(body), 'context') THEN 'context_overflow' WHEN status >= 400 THEN 'http_error' END AS kind FROM c)
SELECT event_id, kind, CASE kind WHEN 'context_overflow' THEN left(body, 500) ELSE coalesce(fault, status::VARCHAR) END AS message FROM k WHERE kind IS NOT NULL"""
)
def call_errors(spark, sf_dir):
    """Calls that brought no reply, and whether they may be tried again."""
    calls = b.read(spark, sf_dir, "events").selectExpr(
        "event_id", "CASE event_id % 9 WHEN 0 THEN 'timeout' WHEN 1 THEN 'connect_error' END AS fault",
        "CASE event_id % 9 WHEN 2 THEN 429 WHEN 3 THEN 503 WHEN 4 THEN 400 WHEN 5 THEN 400 WHEN 6 THEN 404 ELSE 200 END AS status",
        "CASE event_id % 9 WHEN 4 THEN 'Maximum CONTEXT length exceeded by ' || event_id ELSE props END AS body",
    )
    return calls.select("event_id", replies.call_error(F.col("fault"), F.col("status"), F.col("body")).alias("e")).where("e IS NOT NULL").select("event_id", "e.*")


def _gate(name: str, detail: str):
    sql = f"WITH {GATES_SQL} SELECT doc_id, {name} AS outcome, {detail} AS detail FROM gate"

    def run(spark, sf_dir):
        return invoices.gated(spark, sf_dir).select("doc_id", F.col(f"{name}.outcome").alias("outcome"), F.col(f"{name}.detail").alias("detail"))

    QUERIES[f"gate_{name.replace('iban_mod97', 'iban')}"], SQL[f"gate_{name.replace('iban_mod97', 'iban')}"] = run, sql


_gate("grounding", "CASE WHEN bucket = 1 THEN 'total_cents' END")
_gate("arithmetic", "arithmetic_detail")
_gate("iban_mod97", "CASE WHEN bucket = 6 THEN 'checksum_mismatch' WHEN odd = 1 THEN 'malformed_iban' END")
_gate("plausibility", "CASE WHEN bucket = 5 THEN 'total_missing' WHEN odd = 2 THEN 'unparseable_dates' WHEN odd = 3 THEN 'due_date_out_of_range' END")
_gate("business_dedupe", "CAST(duplicate_of AS VARCHAR)")


@query(
    f"""WITH {GATES_SQL} SELECT doc_id, grounding = 'fail' OR arithmetic IN ('fail', 'inconclusive') OR business_dedupe = 'fail' AS is_blocked,
'grounding=' || grounding || ',arithmetic=' || arithmetic || ',iban_mod97=' || iban_mod97 || ',plausibility=' || plausibility || ',business_dedupe=' || business_dedupe AS gates FROM gate"""
)
def gate_verdict(spark, sf_dir):
    told = [F.concat(F.lit(f"{g}="), F.col(f"{g}.outcome")) for g in invoices.GATES]
    return invoices.gated(spark, sf_dir).select("doc_id", gates.blocked({g: F.col(g) for g in invoices.GATES}).alias("is_blocked"), F.concat_ws(",", *told).alias("gates"))


@query(
    f"""WITH {GATES_SQL}, flat AS (SELECT doc_id, unnest(['grounding', 'arithmetic', 'iban_mod97', 'plausibility', 'business_dedupe']) AS gate, unnest([grounding, arithmetic, iban_mod97, plausibility, business_dedupe]) AS o FROM gate)
SELECT doc_id, gate, CASE o WHEN 'pass' THEN 1.0 WHEN 'fail' THEN 0.0 ELSE 0.5 END::DOUBLE AS score FROM flat WHERE o <> 'not_applicable'"""
)
def gate_scores(spark, sf_dir):
    pairs = F.array(*[F.struct(F.lit(g).alias("gate"), F.col(f"{g}.outcome").alias("o")) for g in invoices.GATES])
    flat = invoices.gated(spark, sf_dir).select("doc_id", F.explode(pairs).alias("p"))
    return flat.select("doc_id", F.col("p.gate").alias("gate"), gates.score(F.col("p.o")).alias("score")).where("score IS NOT NULL")


@query(f"WITH {GATES_SQL} SELECT outcome, count(*)::BIGINT AS n FROM routed GROUP BY 1")
def funnel_outcome(spark, sf_dir):
    return invoices.routed(spark, sf_dir).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {GATES_SQL} SELECT doc_id, coalesce(early, 'review:kill_switch') AS outcome FROM early")
def kill_switch_route(spark, sf_dir):
    return invoices.routed(spark, sf_dir, auto_post=False)


@query(
    """SELECT o_orderkey AS doc_id, CASE WHEN o_orderkey % 9 > 0 AND row_number() OVER (PARTITION BY o_custkey, o_orderkey % 500, o_orderkey % 9 = 0 ORDER BY o_orderkey) > 1 THEN 'review:duplicate' ELSE 'complete' END AS commit_outcome FROM orders"""
)
def unique_commit(spark, sf_dir):
    rows = b.read(spark, sf_dir, "orders").selectExpr("o_orderkey AS doc_id", "o_custkey AS vendor", "CASE WHEN o_orderkey % 9 > 0 THEN o_orderkey % 500 END AS number")
    return ops.unique_commit(rows, ["vendor", "number"], [F.col("doc_id")]).select("doc_id", "commit_outcome")


_REQUESTS_SQL = """asked AS (SELECT l_orderkey AS doc_id FROM lineitem GROUP BY 1),
asks AS (SELECT doc_id, 1 AS seq, 'r' || doc_id AS result FROM asked UNION ALL SELECT doc_id, 2, CASE WHEN doc_id % 10 = 0 THEN 'other' ELSE 'r' || doc_id END FROM asked WHERE doc_id % 5 = 0
  UNION ALL SELECT -doc_id, 1, 'r' FROM asked WHERE doc_id % 50 = 7),
totals AS (SELECT l_orderkey AS doc_id, CAST(max(l_linenumber) + CASE WHEN l_orderkey % 11 = 4 THEN 1 ELSE 0 END AS BIGINT) AS shards_total FROM lineitem GROUP BY l_orderkey),
lacking AS (SELECT t.doc_id, CAST(min(r.i) AS INT) AS shard_idx FROM totals t, range(0, 9) r(i)
  WHERE r.i < t.shards_total AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = t.doc_id AND l_linenumber - 1 = r.i) GROUP BY 1)"""


@query(
    f"""WITH {GATES_SQL}, {_REQUESTS_SQL},
told AS (SELECT a.*, m.shard_idx, CASE WHEN o_orderkey IS NULL THEN 'unknown_doc' WHEN m.doc_id IS NOT NULL THEN 'review:shard_output_missing' WHEN r.outcome <> 'complete' THEN r.outcome END AS early
  FROM asks a LEFT JOIN orders ON o_orderkey = a.doc_id LEFT JOIN lacking m ON m.doc_id = a.doc_id LEFT JOIN routed r ON r.doc_id = a.doc_id)
SELECT doc_id, seq, coalesce(early, CASE WHEN seq = 1 THEN 'complete' ELSE 'discarded:not_first_writer' END) AS outcome, shard_idx, early IS NULL AND seq = 2 AND result <> 'r' || doc_id AS diverged FROM told"""
)
def finalise(spark, sf_dir):
    asked = b.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id")).distinct()
    again = asked.where("doc_id % 5 = 0").selectExpr("doc_id", "2 AS seq", "CASE WHEN doc_id % 10 = 0 THEN 'other' ELSE 'r' || doc_id END AS result")
    unknown = asked.where("doc_id % 50 = 7").selectExpr("-doc_id AS doc_id", "1 AS seq", "'r' AS result")
    requests = asked.selectExpr("doc_id", "1 AS seq", "'r' || doc_id AS result").unionByName(again).unionByName(unknown)
    totals = _totals(spark, sf_dir).withColumn("shards_total", F.col("shards_total") + F.when(F.col("doc_id") % 11 == 4, 1).otherwise(0))
    lacking = shards.first_missing(totals, b.deliveries(spark, sf_dir), "doc_id", "shard_idx", "shards_total")
    return ends.finalise(requests, b.ledger(spark, sf_dir), lacking, invoices.routed(spark, sf_dir))


@query(
    f"""WITH {GATES_SQL}, ids AS (SELECT user_id * 97 AS doc_id FROM events GROUP BY 1 UNION SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 1)
SELECT ids.doc_id, 'replay' AS path, CASE WHEN o_orderkey IS NOT NULL AND g.doc_id IS NOT NULL THEN 'cheap' END AS tier,
CASE WHEN o_orderkey IS NULL THEN 'not_found' WHEN g.doc_id IS NULL THEN 'not_yet_assembled' END AS error,
'{{"invoice_no":"' || g.invoice_no || '"' || CASE WHEN bucket = 7 THEN '' ELSE ',"seller":"' || CASE WHEN bucket = 3 THEN 'Example Buyer Ltd' ELSE g.vendor END || '"' END
  || CASE bucket WHEN 5 THEN '' ELSE ',"total_cents":' || CASE bucket WHEN 0 THEN 1 WHEN 1 THEN total + 999999 WHEN 8 THEN -total ELSE total END END || '}}' AS fields,
'grounding=' || grounding || ',arithmetic=' || arithmetic || ',iban_mod97=' || iban_mod97 || ',plausibility=' || plausibility || ',business_dedupe=' || business_dedupe AS gates
FROM ids LEFT JOIN orders ON o_orderkey = ids.doc_id LEFT JOIN gate g ON g.doc_id = ids.doc_id"""
)
def replay_documents(spark, sf_dir):
    """The read-only lane: fields and gates of documents whose text is there."""
    events, orders = b.read(spark, sf_dir, "events"), b.read(spark, sf_dir, "orders")
    ids = events.select((F.col("user_id") * 97).alias("doc_id")).union(orders.where("o_orderkey % 3 = 1").select("o_orderkey")).distinct()
    told = F.concat_ws(",", *[F.concat(F.lit(f"{g}="), F.col(f"{g}.outcome")) for g in invoices.GATES])
    dumped = F.to_json(F.struct("record.invoice_no", "record.seller", "record.total_cents"))  # nulls are left out
    judged = invoices.gated(spark, sf_dir).select("doc_id", dumped.alias("fields"), told.alias("gates"), F.lit("cheap").alias("tier"))
    known = b.ledger(spark, sf_dir).select("doc_id", F.lit(True).alias("known"))
    error = F.when(F.col("known").isNull(), "not_found").when(F.col("tier").isNull(), "not_yet_assembled")
    joined = ids.join(known, "doc_id", "left").join(judged, "doc_id", "left")
    return joined.select("doc_id", F.lit("replay").alias("path"), "tier", error.alias("error"), "fields", "gates")


_CALL = "CASE (doc_id * 7 + tier * 3 + call * call) % 6 WHEN 0 THEN 'ok' WHEN 1 THEN 'transient' WHEN 2 THEN 'schema_invalid' WHEN 3 THEN 'unparseable' WHEN 4 THEN 'context_overflow' ELSE CASE WHEN doc_id % 4 = 0 THEN 'refusal' ELSE 'transient' END END"


@query(
    f"""WITH calls AS (SELECT doc_id, tier, call, {_CALL} AS kind FROM (SELECT o_orderkey AS doc_id FROM orders), range(0, 2) t(tier), range(1, 5) c(call)),
first AS (SELECT doc_id, tier, min(call) AS at, arg_min(kind, call) AS v FROM calls WHERE call <= 3 AND kind IN ('ok', 'refusal', 'context_overflow') GROUP BY ALL),
told AS (SELECT c.doc_id, c.tier, coalesce(max(f.v), 'exhausted') AS v, count(*) FILTER ((f.at IS NULL OR call < f.at) AND kind IN ('schema_invalid', 'unparseable')) AS rep,
  count(*) FILTER ((f.at IS NULL OR call < f.at) AND kind = 'transient') AS ret FROM calls c LEFT JOIN first f ON f.doc_id = c.doc_id AND f.tier = c.tier WHERE call <= 3 GROUP BY ALL),
st AS (SELECT *, CASE WHEN v = 'ok' AND (doc_id + tier) % 3 <> 0 THEN 'complete' WHEN v = 'refusal' THEN 'refused' ELSE 'open' END AS s FROM told)
SELECT a.doc_id, CASE coalesce(CASE WHEN a.s = 'open' THEN z.s ELSE a.s END, 'open') WHEN 'complete' THEN 'complete' WHEN 'refused' THEN 'review:refusal' ELSE 'review:gates_exhausted' END AS outcome,
CASE WHEN a.s = 'complete' THEN 'cheap' WHEN a.s = 'open' AND z.s = 'complete' THEN 'strong' END AS tier_used,
(a.rep + CASE WHEN a.s = 'open' THEN z.rep ELSE 0 END)::BIGINT AS repairs, (a.ret + CASE WHEN a.s = 'open' THEN z.ret ELSE 0 END)::BIGINT AS retries
FROM st a JOIN st z ON z.doc_id = a.doc_id AND z.tier = 1 WHERE a.tier = 0"""
)
def funnel_tiers(spark, sf_dir):
    docs = b.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id"))
    grid = docs.select("doc_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("tier")).select("*", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("call"))
    blocked = docs.select("doc_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("tier")).withColumn("is_blocked", (F.col("doc_id") + F.col("tier")) % 3 == 0)
    return funnel.run_funnel(grid.withColumn("kind", F.expr(_CALL)), blocked)


# ---- ledger -----------------------------------------------------------------

_LEGAL = " OR ".join(f"(f.state = '{a}' AND r.to_state IN ({', '.join(repr(x) for x in t)}))" for a, t in states.TRANSITIONS.items())
_FOLD_SQL = f"""
WITH RECURSIVE {b.REQUESTS_SQL},
ordered AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS n FROM requests),
f AS (SELECT doc_id, 0::BIGINT AS n, 'text_pending' AS state, 0::BIGINT AS accepted, 0::BIGINT AS rejected, NULL::BIGINT AS last_order FROM (SELECT DISTINCT doc_id FROM requests)
  UNION ALL
  SELECT f.doc_id, r.n, CASE WHEN f.state = r.to_state OR {_LEGAL} THEN r.to_state ELSE f.state END, f.accepted + CASE WHEN f.state = r.to_state OR {_LEGAL} THEN 1 ELSE 0 END,
         f.rejected + CASE WHEN f.state = r.to_state OR {_LEGAL} THEN 0 ELSE 1 END, CASE WHEN f.state = r.to_state OR {_LEGAL} THEN r.seq ELSE f.last_order END
  FROM f JOIN ordered r ON r.doc_id = f.doc_id AND r.n = f.n + 1)"""


@query(f"{_FOLD_SQL} SELECT doc_id, arg_max(state, n) AS state, max(accepted) AS accepted, max(rejected) AS rejected, max(last_order) AS last_order FROM f GROUP BY 1")
def transition_fold(spark, sf_dir):
    return ops.transition_fold(b.requests(spark, sf_dir), "doc_id", "seq", "to_state")


@query(
    f"""WITH {b.LEDGER_SQL}, edges AS (SELECT * FROM (VALUES {', '.join(f"('{a}', '{t}')" for a, ts in states.TRANSITIONS.items() for t in ts)}) v(from_state, to_state))
SELECT state, count(*) FILTER (e.to_state IS NULL AND state <> 'extract_pending')::BIGINT AS illegal, count(*)::BIGINT AS n FROM ledger LEFT JOIN edges e ON e.from_state = state AND e.to_state = 'extract_pending' GROUP BY 1"""
)
def illegal_transitions(spark, sf_dir):
    """Of a request to move every document to extract_pending."""
    legal = states.may_follow(F.col("state"), F.lit("extract_pending"))
    return b.ledger(spark, sf_dir).groupBy("state").agg(F.count_if(~legal).alias("illegal"), F.count(F.lit(1)).alias("n"))


@query("SELECT user_id AS doc_id, event_id AS seq, attempt, attempt = 1 AS won FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS attempt FROM events WHERE event_type = 'click')")
def first_writer_wins(spark, sf_dir):
    rows = b.read(spark, sf_dir, "events").where("event_type = 'click'").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("seq"))
    return ops.winner_order(rows, ["doc_id"], [F.col("seq")]).select("doc_id", "seq", F.col("attempt").cast("long").alias("attempt"), "won")


@query(
    """SELECT doc_id, seq, result, committed FROM (SELECT user_id AS doc_id, event_id AS seq, props AS result, first_value(props) OVER (PARTITION BY user_id ORDER BY event_id) AS committed FROM events WHERE event_type = 'purchase') WHERE result <> committed"""
)
def divergence(spark, sf_dir):
    rows = b.read(spark, sf_dir, "events").where("event_type = 'purchase'").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("seq"), F.col("props").alias("result"))
    return ops.divergence(rows, ["doc_id"], [F.col("seq")], "result").select("doc_id", "seq", "result", "committed")


@query(
    """WITH reset AS (SELECT user_id, max(event_id) AS r FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT e.user_id AS doc_id, count(*) FILTER (event_type = 'error' AND event_id > coalesce(r, -1))::BIGINT AS attempts FROM events e LEFT JOIN reset ON reset.user_id = e.user_id GROUP BY 1"""
)
def attempt_counters(spark, sf_dir):
    rows = b.read(spark, sf_dir, "events").withColumnRenamed("user_id", "doc_id")
    return ops.attempts_since_reset(rows, "doc_id", "event_id", "event_type", "error", "purchase")


@query(
    """SELECT user_id AS doc_id, arg_max(event_type, event_id) AS kind, arg_max(value, event_id) FILTER (event_type = 'view') AS value, arg_max(props, event_id) FILTER (event_type = 'error') AS error FROM events GROUP BY 1"""
)
def last_values(spark, sf_dir):
    rows = b.read(spark, sf_dir, "events").selectExpr(
        "user_id AS doc_id", "event_id", "event_type AS kind", "CASE WHEN event_type = 'view' THEN value END AS value", "CASE WHEN event_type = 'error' THEN props END AS error"
    )
    return ops.last_values(rows, "doc_id", "event_id", ["kind", "value", "error"])


@query("SELECT event_type AS key, arg_max(value > 10, event_id) AS value FROM events GROUP BY 1")
def flag_upsert(spark, sf_dir):
    rows = b.read(spark, sf_dir, "events").select(F.col("event_type").alias("key"), "event_id", (F.col("value") > 10).alias("value"))
    return ops.last_values(rows, "key", "event_id", ["value"])


# ---- reconciliation ---------------------------------------------------------


def _stuck(cap: int) -> str:
    return f"""WITH {b.LEDGER_SQL}, {b.DELIVERIES_SQL}, claimed AS (SELECT * FROM ledger
WHERE (state IN ('text_pending', 'text_running') AND state_updated_at < {AS_OF} - INTERVAL 86400 SECOND) OR (state IN ('extract_pending', 'extract_running') AND state_updated_at < {AS_OF} - INTERVAL 8640000 SECOND)
ORDER BY priority DESC, state_updated_at ASC, doc_id LIMIT {cap})"""


def _claimed(spark, sf_dir, cap: int) -> DataFrame:
    return recon.stuck_claim(b.ledger(spark, sf_dir), b.as_of(), cap, 86_400, 8_640_000)


@query(f"{_stuck(500)} SELECT doc_id, state, priority, state_updated_at FROM claimed")
def stuck_claim(spark, sf_dir):
    return _claimed(spark, sf_dir, 500).select("doc_id", "state", "priority", "state_updated_at")


@query(
    f"""{_stuck(500)}, t AS (SELECT *, CASE WHEN state LIKE 'text%' THEN text_attempts ELSE extract_attempts END AS a, state LIKE '%running' AS r FROM claimed)
SELECT doc_id, CASE WHEN r AND a >= 5 THEN 'fail' ELSE 'redrive' END AS action, CASE WHEN r AND a >= 5 THEN 'failed' ELSE replace(state, '_running', '_pending') END AS next_state,
CASE WHEN r AND a >= 5 THEN 'sweeper: exceeded attempt cap in ' || state || ' (' || a || '/5)' END AS reason, r AND a < 5 AS burns_attempt FROM t"""
)
def sweeper_actions(spark, sf_dir):
    return recon.sweep_actions(_claimed(spark, sf_dir, 500)).select("doc_id", "action", "next_state", "reason", "burns_attempt")


@query(
    f"""{_stuck(2000)}, whole AS (SELECT *, CASE WHEN state LIKE 'extract%' THEN 'ocr.completed' WHEN shards_total > 1 THEN 'ocr.split' WHEN has_text_layer THEN 'text.embedded' WHEN page_count <= 1 THEN 'ocr.shard' ELSE 'ocr.split' END AS topic
  FROM claimed WHERE NOT (state = 'text_running' AND shards_total > 1)),
parts AS (SELECT doc_id, page_count, CAST(i AS INT) AS i FROM claimed, range(0, 4) s(i) WHERE state = 'text_running' AND shards_total > 1 AND i < shards_total
  AND NOT EXISTS (SELECT 1 FROM deliveries d WHERE d.doc_id = claimed.doc_id AND d.shard_idx = i))
SELECT doc_id, topic, CASE WHEN topic = 'ocr.shard' THEN 0 END AS shard_idx, CASE WHEN topic = 'ocr.shard' THEN 0 END AS page_start, CASE WHEN topic = 'ocr.shard' THEN page_count END AS page_end,
  CASE WHEN topic <> 'ocr.completed' THEN gcs_path END AS path FROM whole
UNION ALL SELECT doc_id, 'ocr.shard', i, i, CAST(coalesce(least(i + 1, page_count), i + 1) AS INT), 'gs://inbox/shards/' || doc_id || '/' || lpad(i::VARCHAR, 4, '0') || '.pdf' FROM parts"""
)
def redrive_route(spark, sf_dir):
    return recon.redrive(_claimed(spark, sf_dir, 2000), b.deliveries(spark, sf_dir))


@query(f"WITH {b.LEDGER_SQL} SELECT doc_id, build_sha, prompt_version FROM ledger WHERE state = 'failed' AND (build_sha IS DISTINCT FROM '{b.BUILD}' OR prompt_version IS DISTINCT FROM '{b.PROMPT}')")
def dlq_replayable(spark, sf_dir):
    return recon.replayable(b.ledger(spark, sf_dir), b.BUILD, b.PROMPT)


@query(
    f"""WITH {b.LEDGER_SQL}, c AS (SELECT count(*) FILTER (state = 'complete' AND state_updated_at > {AS_OF} - INTERVAL 864000 SECOND)::BIGINT AS completed_in_window,
count(*) FILTER (created_at > {AS_OF} - INTERVAL 864000 SECOND)::BIGINT AS ingested_in_window, count(*) FILTER (state LIKE '%ing')::BIGINT AS in_flight FROM ledger)
SELECT *, completed_in_window > 0 OR NOT (ingested_in_window > 0 OR in_flight > 0) AS healthy FROM c"""
)
def deadmans_switch(spark, sf_dir):
    return recon.liveness(b.ledger(spark, sf_dir), b.as_of(), 864_000)


@query(
    f"""WITH {b.LEDGER_SQL} SELECT state, count(*)::BIGINT AS total, count(*) FILTER (state_updated_at > {AS_OF} - INTERVAL 24 HOUR)::BIGINT AS last_24h, min(state_updated_at) AS oldest, max(state_updated_at) AS newest,
CASE WHEN state = 'failed' THEN count(*) FILTER (build_sha IS NOT DISTINCT FROM '{b.BUILD}' AND prompt_version IS NOT DISTINCT FROM '{b.PROMPT}')::BIGINT END AS not_replayable
FROM ledger WHERE state IN ('failed', 'review') GROUP BY state"""
)
def terminal_report(spark, sf_dir):
    return recon.terminal_report(b.ledger(spark, sf_dir), b.as_of(), b.BUILD, b.PROMPT)


@query(
    f"""WITH {b.LEDGER_SQL}, c AS (SELECT state, left(coalesce(last_error, '(none)'), 80) AS reason, count(*)::BIGINT AS n FROM ledger WHERE state IN ('failed', 'review') GROUP BY ALL)
SELECT state, reason, n, r::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY state ORDER BY n DESC, reason) AS r FROM c) WHERE r <= 5"""
)
def top_reasons(spark, sf_dir):
    return recon.top_reasons(b.ledger(spark, sf_dir))


@query(
    f"""WITH {b.LOG_SQL} SELECT id, doc_id FROM attempt_log WHERE id > (SELECT coalesce(max(id), -1) FROM attempt_log WHERE coalesce(ended_at, started_at) < {EV} - INTERVAL 10 DAY)"""
)
def prune_survivors(spark, sf_dir):
    return recon.prune(b.attempt_log(spark, sf_dir), b.as_of(b.EVENTS_AS_OF), 10).select("id", "doc_id")


@query(f"WITH {b.LEDGER_SQL}, c AS (SELECT count(*)::BIGINT AS total, count(*) FILTER (state IN ('complete', 'review', 'failed'))::BIGINT AS settled, count(*) FILTER (state LIKE '%ing')::BIGINT AS in_flight FROM ledger) SELECT *, settled = total AS drained FROM c")
def drain_status(spark, sf_dir):
    return recon.drain_status(b.ledger(spark, sf_dir))


@query(
    f"""WITH {b.LEDGER_SQL} SELECT l.doc_id, state, CASE WHEN state = 'review' THEN 'extract_pending' WHEN state = 'failed' AND page_count IS NOT NULL THEN CASE WHEN i.k IS NOT NULL THEN 'extract_pending' ELSE 'text_pending' END END AS target,
CASE WHEN state = 'failed' AND page_count IS NULL THEN 'failed_at_triage' WHEN state NOT IN ('review', 'failed') THEN 'not_review_or_failed' END AS error
FROM ledger l LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linenumber = 1) i ON i.k = l.doc_id"""
)
def redrive_targets(spark, sf_dir):
    assembled = b.deliveries(spark, sf_dir).where("shard_idx = 0").select("doc_id")
    return recon.redrive_targets(b.ledger(spark, sf_dir), assembled)


@query(f"WITH {b.LEDGER_SQL}, m AS (SELECT doc_id, state FROM ledger WHERE state = 'review' AND priority = 5) SELECT *, (SELECT count(*) FROM m)::BIGINT AS matched, (SELECT count(*) FROM m) <= 25 AS allowed FROM m")
def bulk_redrive_cap(spark, sf_dir):
    return recon.bulk_redrive(b.ledger(spark, sf_dir), "state = 'review' AND priority = 5")


@query(
    f"""WITH ids AS (SELECT user_id * 97 AS doc_id FROM events GROUP BY 1), {b.LEDGER_SQL}
SELECT ids.doc_id, CASE WHEN l.doc_id IS NULL THEN 'not_found' WHEN i.k IS NULL THEN 'not_yet_assembled' ELSE 'replayed' END AS status
FROM ids LEFT JOIN ledger l ON l.doc_id = ids.doc_id LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) i ON i.k = ids.doc_id"""
)
def replay_status(spark, sf_dir):
    ids = b.read(spark, sf_dir, "events").select((F.col("user_id") * 97).alias("doc_id")).distinct()
    known = b.ledger(spark, sf_dir).select("doc_id", F.lit(True).alias("known"))
    made = b.deliveries(spark, sf_dir).select("doc_id", F.lit(True).alias("made")).distinct()
    status = F.when(F.col("known").isNull(), "not_found").when(F.col("made").isNull(), "not_yet_assembled").otherwise("replayed")
    return ids.join(known, "doc_id", "left").join(made, "doc_id", "left").select("doc_id", status.alias("status"))


@query(f"WITH {b.OUTBOX_SQL} SELECT id, doc_id, topic, payload FROM outbox ORDER BY id LIMIT 50")
def outbox_claim(spark, sf_dir):
    return recon.outbox_claim(b.outbox(spark, sf_dir), 50).select("id", "doc_id", "topic", "payload")


@query(f"WITH {b.OUTBOX_SQL} SELECT floor(epoch({EV} - min(created_at)))::BIGINT AS age_seconds FROM outbox")
def outbox_age(spark, sf_dir):
    return recon.outbox_age(b.outbox(spark, sf_dir), b.as_of(b.EVENTS_AS_OF))


@query(
    f"""WITH {b.LEDGER_SQL} SELECT doc_id, 'complete' AS state, 'document.extracted' AS topic, 'accepted' AS override, '{{"actor":"operator","reason":"checked by hand","was":"review"}}' AS detail,
CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'arithmetic=' || CASE WHEN doc_id % 3 = 0 THEN 'fail' ELSE 'pass' END || ',grounding=' || CASE WHEN doc_id % 3 = 0 THEN 'pass' ELSE 'fail' END || ',' END || 'operator_override=accepted' AS gates
FROM ledger WHERE state = 'review'"""
)
def accept_review(spark, sf_dir):
    one = "named_struct('outcome', CASE WHEN {} THEN 'fail' ELSE 'pass' END, 'detail', CAST(NULL AS STRING))"
    kept = f"CASE WHEN doc_id % 4 <> 0 THEN map('grounding', {one.format('doc_id % 3 <> 0')}, 'arithmetic', {one.format('doc_id % 3 = 0')}) END"
    accepted = recon.accept_review(b.ledger(spark, sf_dir).withColumn("gate_results", F.expr(kept)), "operator", "checked by hand")
    told = F.array_sort(F.transform(F.map_entries("gate_results"), lambda e: F.concat(e["key"], F.lit("="), e["value"]["outcome"])))
    return accepted.select("doc_id", "state", "topic", "override", "detail", F.array_join(told, ",").alias("gates"))


@query(
    """SELECT coalesce(string_agg(r_name, ',' ORDER BY r_name) FILTER (r_regionkey % 2 = 1), '') AS on_gpu, coalesce(string_agg(r_name, ',' ORDER BY r_name) FILTER (r_regionkey % 2 = 0), '') AS on_cpu,
'strong-model' AS missing, CASE WHEN count(*) FILTER (r_regionkey % 2 = 0) > 0 THEN 'restart' ELSE 'pin' END AS action FROM region"""
)
def gpu_watchdog(spark, sf_dir):
    models = b.read(spark, sf_dir, "region").select(F.col("r_name").alias("name"), (F.col("r_regionkey") % 2).alias("size_vram"), F.lit(True).alias("reachable"))
    return recon.watchdog(models, ["strong-model"])


@query(
    """WITH m AS (SELECT n_regionkey AS poll, n_name AS name, n_nationkey % 2 AS v FROM nation),
g AS (SELECT poll, coalesce(string_agg(name, ',' ORDER BY name) FILTER (v = 1), '') AS on_gpu, coalesce(string_agg(name, ',' ORDER BY name) FILTER (v = 0), '') AS on_cpu,
  CASE WHEN count(*) FILTER (v = 1 AND name = 'strong-model') = 0 THEN 'strong-model' ELSE '' END AS missing, count(*) FILTER (v = 0) AS cpu FROM m GROUP BY 1)
SELECT poll, on_gpu, on_cpu, missing, CASE WHEN poll = 3 THEN 'wait' WHEN cpu > 0 THEN CASE WHEN poll = 4 THEN 'would_restart' WHEN poll * 200 < 300 THEN 'cooldown' ELSE 'restart' END ELSE 'pin' END AS action FROM g"""
)
def gpu_watchdog_polls(spark, sf_dir):
    """Polls in a row: a restart is not repeated within the cooldown, nor made in a dry run."""
    polls = b.read(spark, sf_dir, "nation").selectExpr(
        "n_regionkey AS poll", "n_name AS name", "n_nationkey % 2 AS size_vram", "n_regionkey <> 3 AS reachable", "n_regionkey * 200 AS since_restart", "n_regionkey = 4 AS dry_run"
    )
    return recon.watchdog(polls, ["strong-model"], ["poll"], cooldown_seconds=300)


@query(
    """WITH p AS (SELECT user_id % 5 AS lane, event_id * 7 AS "at", event_id // 40 AS total, event_id // 40 - CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS settled FROM events),
l AS (SELECT *, total <> coalesce(lag(total) OVER (PARTITION BY lane ORDER BY "at"), -1) AS moved FROM p),
q AS (SELECT *, "at" - max(CASE WHEN moved THEN "at" END) OVER (PARTITION BY lane ORDER BY "at") AS quiet FROM l)
SELECT lane, "at", total, settled, quiet, total > 0 AND quiet >= 120 AND settled = total AS drained FROM q"""
)
def drain_watch(spark, sf_dir):
    polls = b.read(spark, sf_dir, "events").selectExpr(
        "user_id % 5 AS lane", "event_id * 7 AS at", "event_id DIV 40 AS total", "event_id DIV 40 - CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS settled"
    )
    return recon.drain_watch(polls, ["lane"], 120)


@query(
    f"""WITH {b.LOG_SQL}, m AS (SELECT max(id) AS m FROM attempt_log)
SELECT m + row_number() OVER (ORDER BY o_orderkey % 16, o_orderkey) AS id, o_orderkey AS doc_id, 'extraction' AS stage, CAST(o_orderkey % 3 + 1 AS INT) AS attempt_no,
CASE WHEN o_orderkey % 2 = 0 THEN 'retry' ELSE 'ok' END AS outcome, CASE WHEN o_orderkey % 2 = 0 THEN 'transient' END AS error_class FROM orders, m"""
)
def append_attempts(spark, sf_dir):
    tried = b.read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS doc_id", "'extraction' AS stage", "CAST(o_orderkey % 3 + 1 AS INT) AS attempt_no",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'retry' ELSE 'ok' END AS outcome", "CASE WHEN o_orderkey % 2 = 0 THEN 'transient' END AS error_class",
    )
    return ops.append_attempts(b.attempt_log(spark, sf_dir), tried, ["doc_id"], F.col("doc_id") % 16)


@query("SELECT doc_id, 'crc32c-' || substr(md5(text), 1, 8) AS object_id FROM documents")
def checksum_ids(spark, sf_dir):
    encoded = F.base64(F.unhex(F.substring(F.md5("text"), 1, 8)))
    return b.read(spark, sf_dir, "documents").select("doc_id", text.checksum_id(encoded).alias("object_id"))


@query("SELECT state, count(*)::BIGINT AS n FROM (SELECT " + b._STATE + " AS state FROM orders) GROUP BY 1")
def state_counts(spark, sf_dir):
    return b.ledger(spark, sf_dir).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {b.LEDGER_SQL} SELECT * FROM ledger WHERE doc_id = 42")
def point_lookup(spark, sf_dir):
    return b.ledger(spark, sf_dir).where("doc_id = 42")
