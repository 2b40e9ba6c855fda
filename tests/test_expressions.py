"""Scenarios of the gates and the readers, one row each."""

import pytest
from pyspark.sql import functions as F

from docquarry.functions import gates, text
from docquarry.operators import recon

CLEAN = (
    "INVOICE\nInvoice No: INV-7\nInvoice Date: 2026-01-05\nDue Date: 2026-02-04\nSeller: Acme GmbH\nBuyer: Beta Ltd\nCurrency: EUR\n"
    "IBAN: GB82WEST12345698765432\nLine Item: Widgets | $1,200.00\nLine Item: Service | 300.50\nSubtotal: $1,500.50\nTax: $100.00\nTotal: $1,600.50"
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def record(spark, source):
    return one(spark, text.fields(F.lit(source)))


def test_fields(spark):
    r = record(spark, CLEAN)
    assert (r["invoice_no"], r["seller"], r["buyer"], r["currency"], r["doc_type"]) == ("INV-7", "Acme GmbH", "Beta Ltd", "EUR", "invoice")
    assert (r["total_cents"], r["subtotal_cents"], r["tax_cents"]) == (160050, 150050, 10000)
    assert [tuple(i) for i in r["line_items"]] == [("Widgets", 120000), ("Service", 30050)]
    empty = record(spark, "nothing here")
    assert empty["total_cents"] is None and empty["line_items"] is None and empty["seller"] is None
    assert record(spark, "CREDIT MEMO\nTotal: $(45.10)")["total_cents"] == -4510
    assert record(spark, "Credit Memo for a receipt")["doc_type"] == "credit_memo"
    assert record(spark, "Total: -$3.00")["total_cents"] is None and record(spark, "Total: -3.00")["total_cents"] == -300
    assert record(spark, "Total: 4.297,00")["total_cents"] == 429


def judged(spark, source, kind="invoice", **changes):
    r = text.fields(F.lit(source))
    for k, v in changes.items():
        r = r.withField(k, F.lit(v))
    frame = spark.range(1).select(r.alias("r"), F.lit(source).alias("t"), F.lit(kind).alias("k"))
    told = {
        "grounding": gates.grounding(F.col("r"), F.col("t")), "arithmetic": gates.arithmetic(F.col("k"), F.col("r")),
        "iban": gates.iban_mod97(F.col("r")), "plausibility": gates.plausibility(F.col("k"), F.col("r")),
    }
    row = frame.select(*[c.alias(n) for n, c in told.items()]).first()
    return {n: tuple(row[n]) for n in told}


def test_clean_document_passes(spark):
    assert set(judged(spark, CLEAN).values()) == {("pass", None)}


@pytest.mark.parametrize(
    "changes, gate, wanted",
    [
        ({"total_cents": 999}, "grounding", ("fail", "total_cents")),
        ({"seller": "Nobody"}, "grounding", ("fail", "seller")),
        ({"seller": "ACME gmbh"}, "grounding", ("pass", None)),
        ({"seller": None, "invoice_no": None, "total_cents": None}, "grounding", ("pass", None)),
        ({"seller": "Beta Ltd"}, "grounding", ("pass", None)),
        ({"subtotal_cents": 1}, "arithmetic", ("fail", "subtotal_mismatch")),
        ({"total_cents": 1}, "arithmetic", ("fail", "total_mismatch")),
        ({"total_cents": None}, "arithmetic", ("inconclusive", "total_missing")),
        ({"total_cents": None}, "plausibility", ("fail", "total_missing")),
        ({"total_cents": 1_000_000_001}, "plausibility", ("fail", "total_out_of_range")),
        ({"total_cents": 0, "due_date": "2020-01-01"}, "plausibility", ("fail", "total_out_of_range,due_date_out_of_range")),
        ({"due_date": "2027-01-06"}, "plausibility", ("fail", "due_date_out_of_range")),
        ({"due_date": "2027-01-05"}, "plausibility", ("pass", None)),
        ({"due_date": "2026-2-3"}, "plausibility", ("fail", "unparseable_dates")),
        ({"due_date": "2026-02-30"}, "plausibility", ("fail", "unparseable_dates")),
        ({"due_date": None}, "plausibility", ("pass", None)),
        ({"iban": "GB83WEST12345698765432"}, "iban", ("fail", "checksum_mismatch")),
        ({"iban": "gb82 west 1234 5698 7654 32"}, "iban", ("pass", None)),
        ({"iban": "GB82WEST1234-5698"}, "iban", ("fail", "malformed_iban")),
        ({"iban": None}, "iban", ("not_applicable", None)),
    ],
)
def test_gates(spark, changes, gate, wanted):
    assert judged(spark, CLEAN, **changes)[gate] == wanted


def test_gates_by_kind(spark):
    assert judged(spark, "Total: 10.00")["arithmetic"] == ("inconclusive", "no_line_items")
    memo = judged(spark, "CREDIT MEMO\nTotal: $(45.10)", "credit_memo")
    assert memo["arithmetic"] == ("not_applicable", None) and memo["plausibility"] == ("pass", None) and memo["grounding"] == ("pass", None)
    assert judged(spark, "Total: $(45.10)")["plausibility"] == ("fail", "total_out_of_range")


def test_iban_remainder_equals_big_integers(spark):
    for iban in ["GB82WEST12345698765432", "DE89370400440532013000", "FR1420041010050500013M02606", "XX00ABC"]:
        turned = iban[4:] + iban[:4]
        assert one(spark, gates.iban_remainder(F.lit(iban))) == int("".join(str(int(c, 36)) for c in turned)) % 97


@pytest.mark.parametrize("pages, count, wanted", [([0, 1, 2], 3, "pass"), ([0, 2], 3, "fail"), ([0, 1, 5], 2, "fail"), ([], 0, "pass"), ([1, 1, 0], 2, "pass")])
def test_completeness(spark, pages, count, wanted):
    assert one(spark, gates.completeness(F.lit(pages).cast("array<int>"), F.lit(count)))["outcome"] == wanted


@pytest.mark.parametrize("models, wanted", [([("a", 5, True), ("b", 5, True)], "nothing"), ([("a", 5, True)], "pin"), ([("a", 0, True), ("b", 5, True)], "restart"), ([(None, None, False)], "wait"), ([], "pin")])
def test_watchdog(spark, models, wanted):
    frame = spark.createDataFrame(models, "name string, size_vram long, reachable boolean")
    assert recon.watchdog(frame, ["a", "b"]).first()["action"] == wanted
