"""Extraction backends: rows of (doc_id, tier, attempt, source_text) in, rows with
``record`` and ``error`` out.

The deterministic backend is all expressions.  The backend of a model behind a
service makes its calls in Python, a batch of rows at a time; what their replies
mean is again worked out by expressions.
"""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from functools import partial
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from docquarry.functions import replies
from docquarry.functions.text import fields
from docquarry.sources.calls import Pace, ReplyLog, Told, ask_all


class Extractor(Protocol):
    def extract(self, requests: DataFrame) -> DataFrame: ...


class LabelExtractor:
    """Reads labelled fields; ``behaviours`` (doc_id, attempt or null, behaviour,
    total_cents) make it fail or err on purpose.  A behaviour of an attempt goes
    before one of any attempt."""

    def __init__(self, behaviours: DataFrame | None = None):
        self.behaviours = behaviours

    def extract(self, requests: DataFrame) -> DataFrame:
        plain = requests.withColumn("record", fields(F.col("source_text")))
        if self.behaviours is None:
            return plain.withColumn("error", F.lit(None).cast("string"))
        once = self.behaviours.where("attempt IS NOT NULL").select("doc_id", "attempt", F.col("behaviour").alias("_b1"), F.col("total_cents").alias("_t1"))
        ever = self.behaviours.where("attempt IS NULL").select("doc_id", F.col("behaviour").alias("_b2"), F.col("total_cents").alias("_t2"))
        told = plain.join(once, ["doc_id", "attempt"], "left").join(ever, "doc_id", "left")
        how = F.coalesce("_b1", "_b2", F.lit("correct"))
        record, total = F.col("record"), F.coalesce(F.col("record.total_cents"), F.lit(0))
        wrong = (
            F.when(how == "not_grounded", total + 999_999)
            .when(how == "injected_total", F.coalesce("_t1", "_t2", F.lit(1)))
            .when((how == "diverge_on_redelivery") & (F.col("attempt") >= 2), total + 100)
            .otherwise(record["total_cents"])
        )
        swapped = how == "swapped_roles"
        error = (
            F.when(how.isin("refusal", "context_overflow"), how)
            .when(how.isin("429", "529", "timeout"), "transient")
            .when(how == "schema_invalid", "schema_invalid")
        )
        changed = (
            record.withField("total_cents", wrong.cast("long"))
            .withField("seller", F.when(swapped, record["buyer"]).otherwise(record["seller"]))
            .withField("buyer", F.when(swapped, record["seller"]).otherwise(record["buyer"]))
        )
        return told.select(*requests.columns, F.when(error.isNull(), changed).alias("record"), error.alias("error"))


#: (model, prompt, trace) to (fault or None, status or None, body).  All calls for a
#: document carry one trace.
Call = Callable[[str, str, str], Told]


def http_call(base_url: str, key: str, timeout: float = 200) -> Call:
    """Calls to a service that speaks the chat-completions protocol.  Temperature 0
    keeps repeated calls close together."""

    def call(model: str, prompt: str, trace: str) -> Told:
        body = {"model": model, "messages": [{"role": "user", "content": prompt}], "temperature": 0, "metadata": {"trace_id": trace}}
        head = {"Authorization": f"Bearer {key}", "Content-Type": "application/json"}
        request = urllib.request.Request(f"{base_url}/chat/completions", json.dumps(body).encode(), head)
        try:
            with urllib.request.urlopen(request, timeout=timeout) as reply:
                return None, reply.status, reply.read().decode()
        except urllib.error.HTTPError as answer:
            return None, answer.code, answer.read().decode(errors="replace")
        except TimeoutError:
            return "timeout", None, ""
        except OSError as fault:
            return ("timeout" if "timed out" in str(fault) else "connect_error"), None, ""

    return call


class ServiceExtractor:
    """Asks a model for the record of each text.

    ``models`` names the model of each tier; ``prompt`` makes the text to send
    from the source text and the hint of the attempt before (or None).  Adds
    ``record``, ``error`` (transient, context_overflow, refusal, unparseable,
    schema_invalid, http_error; null for a record) and ``hint`` for the next
    attempt.

    A task has ``concurrency`` calls under way and keeps to ``per_second`` calls of a
    model.  With ``log``, a shared folder, each reply is kept by document, tier,
    attempt and prompt before it is used: a task that runs again, or a frame that
    is evaluated again, asks only what was not answered.  Without it each
    evaluation calls the service again: write the result.
    """

    def __init__(
        self, call: Call, models: list[str], prompt: Callable[[str, str | None], str], concurrency: int = 4, per_second: float | None = None, log: str | None = None
    ):
        self.call, self.models, self.prompt = call, models, prompt
        self.concurrency, self.per_second, self.log = concurrency, per_second, log

    def extract(self, requests: DataFrame) -> DataFrame:
        call, models, prompt = self.call, self.models, self.prompt
        concurrency, per_second, folder = self.concurrency, self.per_second, self.log
        columns = requests.columns
        hinted = requests if "hint" in columns else requests.withColumn("hint", F.lit(None).cast("string"))

        numbered = "attempt" in columns

        def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            log = ReplyLog(folder) if folder else None
            paces = {m: Pace(per_second) for m in models} if per_second else None
            for rows in batches:
                asked = []
                for doc, tier, attempt, text, hint in zip(
                    rows["doc_id"], rows["tier"], rows["attempt"] if numbered else [1] * len(rows), rows["source_text"], rows["hint"], strict=True
                ):
                    model, told = models[int(tier)], prompt(text, hint)
                    asked.append(((doc, tier, attempt, told), partial(call, model, told, str(doc)), model))
                told = ask_all(asked, concurrency, paces, log)
                fault, status, body = (list(x) for x in zip(*told, strict=True)) if told else ([], [], [])
                yield rows.assign(_fault=pd.Series(fault, rows.index, dtype=object), _status=pd.Series(status, rows.index, dtype="Int32"), _body=pd.Series(body, rows.index, dtype=object))

        schema = StructType([*hinted.schema.fields, StructField("_fault", StringType()), StructField("_status", IntegerType()), StructField("_body", StringType())])
        told = hinted.mapInPandas(ask, schema)
        content = F.get_json_object("_body", "$.choices[0].message.content")
        message = F.get_json_object("_body", "$.choices[0].message")
        # a proxy's page, or a reply of another shape: asked again, unlike an empty completion
        odd = F.when(~F.coalesce(message.startswith("{"), F.lit(False)), F.struct(F.lit("transient").alias("kind"), F.lit("no completion in the reply").alias("message")))
        failed = F.coalesce(replies.call_error(F.col("_fault"), F.col("_status"), F.col("_body")), odd)
        read = told.select("*", failed.alias("_failed"), F.when(failed.isNull(), replies.parse_reply(content)).alias("_reply"))
        checked = read.withColumn("_checked", replies.validate(F.col("_reply.json")))
        error = F.coalesce(
            F.col("_failed.kind"),
            F.when(F.col("_reply.kind") != "ok", F.col("_reply.kind")),
            F.when(F.col("_checked.outcome") == "fail", F.lit("schema_invalid")),
        )
        hint = replies.repair_hint(F.col("_reply.kind"), F.col("_reply.message"), F.col("_checked.errors"))
        return checked.select(*[c for c in columns if c != "hint"], F.col("_checked.record").alias("record"), error.alias("error"), hint.alias("hint"))
