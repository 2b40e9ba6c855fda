"""Model replies: the JSON in them, what a failed call means, and the typed record.

Nothing here runs Python on an executor; values of unknown type are variants.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquarry.functions.text import bind

# What a record holds, in this order, and how replies are cut.
KINDS_OF_DOCUMENT = ("invoice", "receipt", "credit_memo")
STRINGS = ("invoice_no", "invoice_date", "due_date", "seller", "buyer")
AMOUNTS = ("total_cents", "subtotal_cents", "tax_cents")
CURRENCY = "USD"
FENCED = r"(?s)```(?:json)?\s*(\{.*?\})\s*```"
BRACED = r"(?s)\{.*\}"
SHOWN = 500


def _result(kind: str, message: Column | None = None, text: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit(kind).alias("kind"), (none if message is None else message).alias("message"), (none if text is None else text).alias("json"))


def _is_one(text: Column) -> Column:
    """Whether ``text`` is one JSON value and nothing else.  The parser lets pass what
    follows a value, so it is given the only element of a list instead."""
    return bind(
        F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), lambda v: v.isNotNull() & F.try_variant_get(v, "$[1]", "variant").isNull()
    )


def parse_reply(raw: Column) -> Column:
    """struct of ``kind`` (ok, refusal, unparseable), ``message`` and ``json``, the
    object's text.  A fenced object goes before the widest pair of braces; of a
    reply that cannot be read the message holds its first SHOWN characters."""
    fenced = F.regexp_extract(raw, FENCED, 1)
    shown = F.left(raw, F.lit(SHOWN))

    def judged(text: Column) -> Column:
        return (
            F.when(text == "", _result("unparseable", shown))
            .when(~_is_one(text), _result("unparseable", F.concat(F.lit("invalid json: "), shown)))
            .otherwise(_result("ok", None, text))
        )

    blank = raw.isNull() | ~raw.rlike(r"\S")
    found = F.regexp_extract(F.when(fenced != "", fenced).otherwise(raw), BRACED, 0)
    return F.when(blank, _result("refusal", F.lit("empty completion"))).otherwise(bind(found, judged))


def call_error(fault: Column, status: Column, body: Column) -> Column:
    """struct of ``kind`` and ``message`` of a call that brought no reply: transient
    faults may be tried again, an overflow may not, any other status from 400
    on is an error of its own; null for a call that succeeded."""
    told = lambda kind, message: F.struct(F.lit(kind).alias("kind"), message.alias("message"))
    return (
        F.when(fault.isin("timeout", "connect_error"), told("transient", fault))
        .when((status == 429) | (status >= 500), told("transient", status.cast("string")))
        .when((status == 400) & F.contains(F.lower(body), F.lit("context")), told("context_overflow", F.left(body, F.lit(SHOWN))))
        .when(status >= 400, told("http_error", status.cast("string")))
    )


def repair_hint(kind: Column, message: Column, errors: Column) -> Column:
    """What the next attempt at the same tier is told; null where none is made."""
    return F.when(kind == "unparseable", F.concat(F.lit("response was not valid JSON: "), message)).when(
        F.length(errors) > 0, F.concat(F.lit("schema errors: "), errors)
    )


def _read(value: Column, error: Column) -> Column:
    return F.struct(value.alias("value"), error.alias("error"))


def _typed(value: Column, use: Callable[[Column, Column], Column]) -> Column:
    """``use`` of a variant and the name of its type: null for what is absent and
    VOID for a JSON null."""
    return bind(F.struct(value.alias("v"), F.schema_of_variant(value).alias("k")), lambda x: use(x["v"], x["k"]))


def string(value: Column, required: bool = False) -> Column:
    """struct of ``value`` and ``error``: only strings are strings."""
    nothing = F.lit(None).cast("string")

    def use(v: Column, k: Column) -> Column:
        empty = F.when(k.isNull(), F.lit("missing")).when(k == "VOID", F.lit("string_type")) if required else nothing
        return _read(
            F.when(k == "STRING", F.try_variant_get(v, "$", "string")),
            F.when(k.isNull() | (k == "VOID"), empty).when(k != "STRING", F.lit("string_type")),
        )

    return _typed(value, use)


def integer(value: Column, required: bool = False) -> Column:
    """struct of ``value`` and ``error``, read laxly: whole numbers of any spelling,
    strings of them, and booleans."""
    nothing = F.lit(None).cast("string")

    def use(v: Column, k: Column) -> Column:
        number = F.try_variant_get(v, "$", "double")
        text = F.trim(F.try_variant_get(v, "$", "string"))
        whole = text.rlike(r"^[+-]?[0-9]+(\.0*)?$")
        fraction = k.startswith("DECIMAL") | (k == "DOUBLE") | (k == "FLOAT")
        empty = F.when(k.isNull(), F.lit("missing")).when(k == "VOID", F.lit("int_type")) if required else nothing
        read = (
            F.when(k == "BIGINT", F.try_variant_get(v, "$", "bigint"))
            .when(k == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("bigint"))
            .when(fraction & (number == F.floor(number)), F.floor(number))
            .when((k == "STRING") & whole, F.regexp_replace(text, r"\.0*$", "").try_cast("bigint"))
        )
        error = (
            F.when(k.isNull() | (k == "VOID"), empty)
            .when(k.isin("BIGINT", "BOOLEAN"), nothing)
            .when(fraction, F.when(number != F.floor(number), F.lit("int_from_float")))
            .when(k == "STRING", F.when(~whole, F.lit("int_parsing")))
            .otherwise(F.lit("int_type"))
        )
        return _read(read, error)

    return _typed(value, use)


def _line_items(value: Column) -> Column:
    """struct of ``value`` (array of structs) and ``errors`` (array of strings)."""
    none = F.array().cast("array<string>")

    def one(item: Column, at: Column) -> Column:
        at_error = lambda name, e: F.when(e.isNotNull(), F.concat(F.lit("line_items."), at.cast("string"), F.lit(name), F.lit(":"), e))
        is_object = F.coalesce(F.schema_of_variant(item).startswith("OBJECT"), F.lit(False))
        parts = F.struct(
            string(F.try_variant_get(item, "$.description", "variant"), True).alias("d"), integer(F.try_variant_get(item, "$.amount_cents", "variant"), True).alias("a")
        )

        def judged(p: Column) -> Column:
            errors = F.array_compact(F.array(at_error(".description", p["d"]["error"]), at_error(".amount_cents", p["a"]["error"])))
            told = F.struct(p["d"]["value"].alias("description"), p["a"]["value"].alias("amount_cents"))
            return F.struct(told.alias("item"), F.when(is_object, errors).otherwise(F.array(at_error("", F.lit("model_type")))).alias("errors"))

        return bind(parts, judged)

    def use(v: Column, k: Column) -> Column:
        is_list = k.startswith("ARRAY")
        items = F.transform(F.try_variant_get(v, "$", "array<variant>"), one)
        wrong = F.when(k.isNotNull() & (k != "VOID") & ~is_list, F.array(F.lit("line_items:list_type"))).otherwise(none)
        return bind(
            F.when(F.coalesce(is_list, F.lit(False)), items),
            lambda xs: F.struct(
                F.transform(xs, lambda x: x["item"]).alias("value"), F.concat(wrong, F.coalesce(F.flatten(F.transform(xs, lambda x: x["errors"])), none)).alias("errors")
            ),
        )

    return _typed(value, use)


def validate(json: Column) -> Column:
    """struct of ``outcome`` (pass, fail), ``errors`` (``place:kind``, in the order of
    the record) and ``record`` (null on fail) of an object's text; null without a
    text.  Unknown keys are let pass; absent fields are null, the type invoice and
    the currency CURRENCY."""

    def told(v: Column) -> Column:
        at = lambda name: F.try_variant_get(v, f"$.{name}", "variant")
        kind = string(at("doc_type"))
        known = kind["value"].isin(*KINDS_OF_DOCUMENT)
        absent = F.schema_of_variant(at("doc_type")).isNull()
        currency = string(at("currency"), True)
        read = {"doc_type": F.when(absent, "invoice").otherwise(kind["value"])}
        wrong = {"doc_type": F.when(~absent & ~F.coalesce(known, F.lit(False)), F.lit("literal_error"))}
        for name in STRINGS:
            read[name], wrong[name] = string(at(name))["value"], string(at(name))["error"]
        read["currency"] = F.coalesce(currency["value"], F.lit(CURRENCY))
        wrong["currency"] = F.when(currency["error"] != "missing", currency["error"])
        for name in AMOUNTS:
            read[name], wrong[name] = integer(at(name))["value"], integer(at(name))["error"]
        read["iban"], wrong["iban"] = string(at("iban"))["value"], string(at("iban"))["error"]

        def together(items: Column) -> Column:
            errors = F.concat(
                F.array_compact(F.array(*[F.when(e.isNotNull(), F.concat(F.lit(f"{name}:"), e)) for name, e in wrong.items()])), items["errors"]
            )
            record = F.struct(*[c.alias(name) for name, c in read.items()], items["value"].alias("line_items"))
            return bind(
                errors,
                lambda e: F.struct(
                    F.when(F.size(e) > 0, "fail").otherwise("pass").alias("outcome"), F.array_join(e, ",").alias("errors"), F.when(F.size(e) == 0, record).alias("record")
                ),
            )

        return bind(_line_items(at("line_items")), together)

    return F.when(json.isNotNull(), bind(F.try_parse_json(json), told))
