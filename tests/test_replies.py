"""Replies of models: parsing, typed records, calls and the attempts of a tier."""

import json
import random
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from docquarry.functions import replies
from docquarry.operators import funnel
from docquarry.sources import extractors


def parsed(spark, *texts):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, raw string")
    out = rows.select("k", replies.parse_reply(F.col("raw")).alias("p")).orderBy("k").collect()
    return [tuple(r["p"]) for r in out]


def test_replies(spark):
    long = "no object here " * 100
    assert parsed(spark, None, " \n", long, 'a ```json\n{"a": {"b": 1}}\n``` {c}', '```\n{"a": 1}\n```', 'x {"a": "}"} y', '{"a": 1} {"b": 2}', "{}", '{"a": 1}, {"b": 2}') == [
        ("refusal", "empty completion", None),
        ("refusal", "empty completion", None),
        ("unparseable", long[:500], None),
        ("ok", None, '{"a": {"b": 1}}'),
        ("ok", None, '{"a": 1}'),
        ("ok", None, '{"a": "}"}'),
        ("unparseable", 'invalid json: {"a": 1} {"b": 2}', None),
        ("ok", None, "{}"),
        ("unparseable", 'invalid json: {"a": 1}, {"b": 2}', None),
    ]


@pytest.mark.parametrize(
    "given, errors",
    [
        ({}, ""),
        ({"doc_type": None}, "doc_type:literal_error"),
        ({"doc_type": "Invoice"}, "doc_type:literal_error"),
        ({"currency": None}, "currency:string_type"),
        ({"currency": "EUR", "seller": None, "iban": None, "line_items": None, "total_cents": None}, ""),
        ({"seller": 5, "buyer": True, "invoice_no": [], "iban": {}}, "invoice_no:string_type,seller:string_type,buyer:string_type,iban:string_type"),
        ({"total_cents": "12", "tax_cents": 3.0, "subtotal_cents": False}, ""),
        ({"total_cents": " -7.00 ", "tax_cents": "1.5", "subtotal_cents": ""}, "subtotal_cents:int_parsing,tax_cents:int_parsing"),
        ({"total_cents": 1.25, "tax_cents": {}, "subtotal_cents": [1]}, "total_cents:int_from_float,subtotal_cents:int_type,tax_cents:int_type"),
        ({"line_items": []}, ""),
        ({"line_items": "a"}, "line_items:list_type"),
        ({"line_items": [{"description": "a", "amount_cents": "4", "more": 1}, {}, None]}, "line_items.1.description:missing,line_items.1.amount_cents:missing,line_items.2:model_type"),
        ({"line_items": [{"description": None, "amount_cents": None}]}, "line_items.0.description:string_type,line_items.0.amount_cents:int_type"),
    ],
)
def test_typed_record(spark, given, errors):
    told = spark.range(1).select(replies.validate(F.lit(json.dumps(given))).alias("v")).first()["v"]
    assert told["errors"] == errors and told["outcome"] == ("fail" if errors else "pass") and (told["record"] is None) == bool(errors)


def test_read_values(spark):
    given = {"doc_type": "receipt", "total_cents": "12.0", "tax_cents": True, "subtotal_cents": 3.0, "line_items": [{"description": "d", "amount_cents": "5"}]}
    r = spark.range(1).select(replies.validate(F.lit(json.dumps(given))).alias("v")).first()["v"]["record"]
    assert (r["doc_type"], r["currency"], r["total_cents"], r["tax_cents"], r["subtotal_cents"]) == ("receipt", "USD", 12, 1, 3)
    assert [tuple(i) for i in r["line_items"]] == [("d", 5)]
    assert spark.range(1).select(replies.validate(F.lit(None).cast("string")).alias("v")).first()["v"] is None


def prompt(text, hint):
    return f"{text}|{hint or ''}"


@pytest.fixture
def service():
    """Answers by the text of the prompt."""

    class Answers(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            text, _, hint = asked["messages"][0]["content"].partition("|")
            status, content = 200, f'{{"seller": "{asked["model"]}", "total_cents": 5}}'
            if text == "busy":
                status = 429
            elif text == "broken":
                status = 503
            elif text == "long":
                status, content = 400, "maximum Context length"
            elif text == "denied":
                status = 401
            elif text == "refuses":
                content = ""
            elif text == "mends" and not hint.startswith("schema errors: total_cents:int_parsing"):
                content = '{"total_cents": "x"}'
            elif text == "prose" and not hint.startswith("response was not valid JSON: I think"):
                content = "I think so"
            body = content if status != 200 else json.dumps({"choices": [{"message": {"content": content}}]})
            self.send_response(status)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Answers)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_a_tier_over_a_service(spark, service, tmp_path):
    texts = ["fine", "busy", "broken", "long", "denied", "refuses", "mends", "prose"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, source_text string")
    made = extractors.ServiceExtractor(extractors.http_call(service, "key", 10), ["small", "large"], prompt)
    kept = []

    def keep(frame):
        kept.append(f"{tmp_path}/{len(kept)}")
        frame.write.parquet(kept[-1])
        return spark.read.parquet(kept[-1])

    calls, records = funnel.call_tier(docs, 1, made.extract, keep)
    kinds = {}
    for r in calls.orderBy("doc_id", "call").collect():
        kinds.setdefault(texts[r["doc_id"]], []).append(r["kind"])
    assert kinds == {
        "fine": ["ok"], "busy": ["transient"] * 3, "broken": ["transient"] * 3, "long": ["context_overflow"], "denied": ["http_error"],
        "refuses": ["refusal"], "mends": ["schema_invalid", "ok"], "prose": ["unparseable", "ok"],
    }
    assert {(texts[r["doc_id"]], r["record"]["seller"]) for r in records.collect()} == {(t, "large") for t in ("fine", "mends", "prose")}
    told = {r["doc_id"]: (r["verdict"], r["repairs"], r["retries"]) for r in funnel.tier_results(calls).collect()}
    assert told[6] == ("ok", 1, 0) and told[1] == ("exhausted", 0, 3) and told[3] == ("context_overflow", 0, 0)


def test_no_service(spark):
    docs = spark.createDataFrame([(1, "a", 0)], "doc_id long, source_text string, tier int")
    made = extractors.ServiceExtractor(extractors.http_call("http://127.0.0.1:9", "key", 1), ["m"], prompt)
    row = made.extract(docs).first()
    assert row["error"] == "transient" and row["record"] is None
    assert made.extract(docs.limit(0)).count() == 0


# ---- a plain validator beside the expressions -------------------------------

ORDER = ["doc_type", "invoice_no", "invoice_date", "due_date", "seller", "buyer", "currency", "total_cents", "subtotal_cents", "tax_cents", "iban"]


def plain_string(given, name, required=False):
    if name not in given:
        return None, "missing" if required else None
    value = given[name]
    if value is None:
        return None, "string_type" if required else None
    return (value, None) if isinstance(value, str) else (None, "string_type")


def plain_integer(given, name, required=False):
    if name not in given:
        return None, "missing" if required else None
    value = given[name]
    if value is None:
        return None, "int_type" if required else None
    if isinstance(value, (bool, int)):
        return int(value), None
    if isinstance(value, float):
        return (int(value), None) if value == int(value) else (None, "int_from_float")
    if isinstance(value, str):
        digits, _, rest = value.strip(" ").partition(".")
        sound = digits.lstrip("+-").isascii() and digits.lstrip("+-").isdigit() and len(digits) - len(digits.lstrip("+-")) <= 1
        return (int(digits), None) if sound and not rest.strip("0") else (None, "int_parsing")
    return None, "int_type"


def plain_record(given):
    """The errors and the record of an object, field after field."""
    errors, record = [], {}
    for name in ORDER:
        value, error = (plain_integer if name.endswith("_cents") else plain_string)(given, name)
        if name == "doc_type":
            value, error = ("invoice", None) if name not in given else (value, None if value in ("invoice", "receipt", "credit_memo") else "literal_error")
        if name == "currency":
            value, error = ("USD", None) if name not in given else (value, "string_type" if value is None else error)
        record[name] = value
        errors += [f"{name}:{error}"] if error else []
    items = given.get("line_items")
    record["line_items"] = None
    if items is not None and not isinstance(items, list):
        errors.append("line_items:list_type")
    elif items is not None:
        record["line_items"] = []
        for k, item in enumerate(items):
            if not isinstance(item, dict):
                errors.append(f"line_items.{k}:model_type")
                continue
            (text, one), (cents, two) = plain_string(item, "description", True), plain_integer(item, "amount_cents", True)
            errors += [f"line_items.{k}.{place}:{e}" for place, e in (("description", one), ("amount_cents", two)) if e]
            record["line_items"].append((text, cents))
    return ",".join(errors), None if errors else record


def test_any_object_is_read_as_by_a_plain_validator(spark):
    rng = random.Random(17)
    values = [None, True, False, 5, -3, 10**12, 0, 2.0, 2.5, -0.5, 1000.0, "x", "", " ", " 12 ", "+7", "-0", "--1", "4.000", "4.5", "1e3", "٣", "4.", ".0", "invoice", "receipt", "EUR", [], [1], {}, {"a": 1}]
    calm = {"doc_type": ["invoice", "credit_memo"], "currency": ["EUR"], "total_cents": [5, "7.0", 3.0, True, None], "seller": ["Acme", None, "ü 日"]}

    def item():
        return rng.choice([None, 3, {"description": rng.choice(values), "amount_cents": rng.choice(values)}, {"description": "d", "amount_cents": rng.choice([1, "2"])}, {"amount_cents": 4}])

    given = []
    for k in range(500):
        one = {n: rng.choice(calm.get(n, ["text" if not n.endswith("cents") else 1, None]) if k % 2 else values) for n in ORDER if rng.random() < 0.6}
        if rng.random() < 0.5:
            one["line_items"] = rng.choice([None, "x", 5, {}, [item() for _ in range(rng.randrange(4))], [{"description": "d", "amount_cents": 2}] * rng.randrange(3)])
        given.append(one)
    frame = spark.createDataFrame([(k, json.dumps(g)) for k, g in enumerate(given)], "k int, raw string")
    passed = 0
    for r in frame.select("k", replies.validate(F.col("raw")).alias("v")).collect():
        errors, record = plain_record(given[r["k"]])
        assert r["v"]["errors"] == errors and r["v"]["outcome"] == ("fail" if errors else "pass"), given[r["k"]]
        if record is not None:
            passed += 1
            told = r["v"]["record"].asDict()
            told["line_items"] = None if told["line_items"] is None else [tuple(i) for i in told["line_items"]]
            assert told == record, given[r["k"]]
    assert 50 < passed < 450
