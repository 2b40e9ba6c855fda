"""How the tables at hand stand for the ledger and its neighbours.

Each binding exists twice: as a DataFrame, and as the DuckDB text of a common
table expression that the oracles build on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"
BUILD, PROMPT = "b1", "p1"


def as_of(text: str = AS_OF) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_STATE = """CASE o_orderstatus
  WHEN 'P' THEN CASE o_orderkey % 4 WHEN 0 THEN 'text_pending' WHEN 1 THEN 'text_running' WHEN 2 THEN 'extract_pending' ELSE 'extract_running' END
  WHEN 'F' THEN CASE o_orderkey % 3 WHEN 0 THEN 'complete' WHEN 1 THEN 'failed' ELSE 'review' END
  ELSE CASE o_orderkey % 6 WHEN 0 THEN 'complete' WHEN 1 THEN 'text_running' WHEN 2 THEN 'extract_running' WHEN 3 THEN 'review' WHEN 4 THEN 'failed' ELSE 'text_pending' END END"""
_ERROR = """CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'zero_byte_object' WHEN 2 THEN 'encrypted_pdf'
  WHEN 3 THEN 'unsupported_mime:text/plain' WHEN 4 THEN 'page_ceiling_exceeded:25' ELSE 'sweeper: exceeded attempt cap in text_running (5/5)' END"""
_COLUMNS = [
    ("doc_id", "o_orderkey"),
    ("gcs_path", "'gs://inbox/' || o_orderkey || '.pdf'"),
    ("state", _STATE),
    ("state_updated_at", "o_orderdate"),
    ("created_at", "o_orderdate - INTERVAL '1' DAY * CAST(o_orderkey % 5 AS INT)"),
    ("priority", "6 - CAST(substr(o_orderpriority, 1, 1) AS INT)"),
    ("vendor", "o_custkey"),
    ("invoice_no", "o_orderkey % 500"),
    ("page_count", "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderkey % 30 AS INT) END"),
    ("has_text_layer", "o_orderkey % 2 = 0"),
    ("shards_total", "CAST(o_orderkey % 4 + 1 AS INT)"),
    ("text_attempts", "CAST(o_orderkey % 7 AS INT)"),
    ("extract_attempts", "CAST(o_orderkey % 6 AS INT)"),
    ("last_error", _ERROR),
    ("build_sha", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'b' || (o_orderkey % 2) END"),
    ("prompt_version", "'p' || (o_orderkey % 3)"),
]
LEDGER_SQL = "ledger AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in _COLUMNS) + " FROM orders)"


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in _COLUMNS])


DELIVERIES_SQL = "deliveries AS (SELECT l_orderkey AS doc_id, CAST(l_linenumber - 1 AS INT) AS shard_idx FROM lineitem)"


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard completions with redelivery."""
    return read(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS doc_id", "CAST(l_linenumber - 1 AS INT) AS shard_idx")


_REQUEST = """CASE event_type WHEN 'signup' THEN 'text_running' WHEN 'view' THEN 'extract_pending' WHEN 'click' THEN 'extract_running'
  WHEN 'purchase' THEN 'review' ELSE CASE event_id % 3 WHEN 0 THEN 'failed' WHEN 1 THEN 'text_pending' ELSE 'complete' END END"""
REQUESTS_SQL = f"requests AS (SELECT user_id AS doc_id, event_id AS seq, {_REQUEST} AS to_state FROM events)"


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transition requests, ordered by ``seq``."""
    return read(spark, sf_dir, "events").selectExpr("user_id AS doc_id", "event_id AS seq", f"{_REQUEST} AS to_state")


_TOPIC = "CASE event_type WHEN 'signup' THEN 'triage.requests' WHEN 'view' THEN 'text.embedded' WHEN 'click' THEN 'ocr.shard' WHEN 'error' THEN 'ocr.split' ELSE 'document.extracted' END"
OUTBOX_SQL = f"outbox AS (SELECT event_id AS id, user_id AS doc_id, {_TOPIC} AS topic, props AS payload, ts AS created_at FROM events)"


def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr("event_id AS id", "user_id AS doc_id", f"{_TOPIC} AS topic", "props AS payload", "ts AS created_at")


_LOG = ["event_id AS id", "user_id AS doc_id", "CASE WHEN event_id % 4 = 0 THEN NULL ELSE ts END AS started_at", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts END AS ended_at"]
LOG_SQL = f"attempt_log AS (SELECT {', '.join(_LOG)} FROM events)"


def attempt_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(*_LOG)


# Uploads: documents stand for objects, their text for bytes.
_OBJECT = [
    ("doc_id", "doc_id"),
    ("gcs_path", "'gs://inbox/upload-' || doc_id || '.pdf'"),
    ("content_id", "md5(text)"),
    ("size", "CASE WHEN doc_id % 23 = 0 THEN 0 ELSE n_chars END"),
    ("content_type", "CASE doc_id % 11 WHEN 0 THEN NULL WHEN 1 THEN 'text/plain' WHEN 2 THEN 'image/png' ELSE 'application/pdf' END"),
    ("encrypted", "doc_id % 13 = 5"),
    ("corrupt", "doc_id % 19 = 7"),
    ("page_count", "CAST(n_chars // 400 + 1 AS INT)"),
    ("text", "text"),
]
OBJECTS_SQL = "objects AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in _OBJECT) + " FROM documents)"


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").selectExpr(*[f"{e.replace('n_chars // 400', 'n_chars DIV 400')} AS {n}" for n, e in _OBJECT])


PAGES_SQL = "pages_in AS (SELECT conv_id AS doc_id, CAST(turn AS INT) AS page_no, text FROM conversations)"


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of multi-page artifacts."""
    return read(spark, sf_dir, "conversations").selectExpr("conv_id AS doc_id", "CAST(turn AS INT) AS page_no", "text")
