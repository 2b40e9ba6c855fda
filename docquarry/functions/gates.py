"""The quality gates.  Each is a struct of ``outcome`` (pass, fail, inconclusive
or not_applicable) and ``detail`` (null on pass)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docquarry.functions.text import bind, contains_ignoring_case, money_renderings, page_range

# Which gates block, and what an inconclusive one does.
BLOCKING = ("grounding", "arithmetic", "business_dedupe")
BLOCKING_INCONCLUSIVE = ("grounding", "arithmetic", "business_dedupe")
CEILING_CENTS = 1_000_000_000
SCORES = {"pass": 1.0, "fail": 0.0, "inconclusive": 0.5}


def result(outcome: Column | str, detail: Column | None = None) -> Column:
    told = F.lit(outcome) if isinstance(outcome, str) else outcome
    return F.struct(told.alias("outcome"), (F.lit(None) if detail is None else detail).cast("string").alias("detail"))


def grounding(record: Column, text: Column) -> Column:
    """Number, seller and total occur in the text; absent ones are skipped."""
    missing = F.array_compact(
        F.array(
            *[
                F.when((F.length(record[k]) > 0) & ~contains_ignoring_case(text, record[k]), F.lit(k))
                for k in ("invoice_no", "seller")
            ],
            F.when(
                record["total_cents"].isNotNull() & ~F.exists(money_renderings(record["total_cents"]), lambda r: F.contains(text, r)),
                F.lit("total_cents"),
            ),
        )
    )
    return F.when(F.size(missing) > 0, result("fail", F.array_join(missing, ","))).otherwise(result("pass"))


def arithmetic(kind: Column, record: Column) -> Column:
    """``kind`` is the type known before extraction."""
    items, declared, total = record["line_items"], record["subtotal_cents"], record["total_cents"]
    computed = F.aggregate(items, F.lit(0).cast("long"), lambda a, x: a + x["amount_cents"])
    full = computed + F.coalesce(record["tax_cents"], F.lit(0))
    return (
        F.when(~kind.eqNullSafe(F.lit("invoice")), result("not_applicable"))
        .when(F.coalesce(F.size(items), F.lit(0)) <= 0, result("inconclusive", F.lit("no_line_items")))
        .when(declared.isNotNull() & (declared != computed), result("fail", F.lit("subtotal_mismatch")))
        .when(total.isNull(), result("inconclusive", F.lit("total_missing")))
        .when(total != full, result("fail", F.lit("total_mismatch")))
        .otherwise(result("pass"))
    )


def iban_remainder(iban: Column) -> Column:
    """Remainder by 97 of the rearranged number, letter by letter; null where a
    character is no letter or digit."""

    def folded(clean: Column) -> Column:
        turned = F.concat(F.substring(clean, 5, 1_000_000), F.substring(clean, 1, 4))
        # ASCII digits and upper-case letters stand for 0 .. 35, anything else for null
        codes = F.transform(F.split(turned, ""), lambda c: F.ascii(c))
        value = lambda a: F.when(a.between(48, 57), a - 48).when(a.between(65, 90), a - 55)
        step = lambda a, v: ((a * F.when(v > 64, 100).otherwise(10) + value(v)) % 97).cast("int")
        return F.when(F.length(clean) > 0, F.aggregate(codes, F.lit(0), step))

    return bind(F.upper(F.replace(iban, F.lit(" "), F.lit(""))), folded)


def iban_mod97(record: Column) -> Column:
    given = F.coalesce(F.length(record["iban"]), F.lit(0)) > 0
    judged = bind(
        iban_remainder(record["iban"]),
        lambda left: F.when(left.isNull(), result("fail", F.lit("malformed_iban")))
        .when(left == 1, result("pass"))
        .otherwise(result("fail", F.lit("checksum_mismatch"))),
    )
    return F.when(given, judged).otherwise(result("not_applicable"))


def iso_date(text: Column) -> Column:
    return F.when(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def plausibility(kind: Column, record: Column, ceiling: int = CEILING_CENTS) -> Column:
    total, issue, due = record["total_cents"], record["invoice_date"], record["due_date"]
    size = F.when(kind.eqNullSafe(F.lit("credit_memo")), F.abs(total)).otherwise(total)
    both = (F.length(issue) > 0) & (F.length(due) > 0)

    def in_order(dates: Column) -> Column:
        first, last = dates["first"], dates["last"]
        return F.when(first.isNull() | last.isNull(), F.lit("unparseable_dates")).when(
            (last < first) | (last > F.date_add(first, 365)), F.lit("due_date_out_of_range")
        )

    reasons = F.array(
        F.when(total.isNull(), F.lit("total_missing")).when((size <= 0) | (size > ceiling), F.lit("total_out_of_range")),
        F.when(both, bind(F.struct(iso_date(issue).alias("first"), iso_date(due).alias("last")), in_order)),
    )
    return bind(
        F.array_compact(reasons), lambda r: F.when(F.size(r) > 0, result("fail", F.array_join(r, ","))).otherwise(result("pass"))
    )


def completeness(pages: Column, count: Column) -> Column:
    """The pages are 0 .. count - 1; as sets, so repeats do not show."""
    wanted = page_range(count)
    missing, extra = F.array_sort(F.array_except(wanted, pages)), F.array_sort(F.array_except(pages, wanted))
    detail = F.concat(
        F.lit("missing="), F.array_join(missing.cast("array<string>"), ","), F.lit(";unexpected="), F.array_join(extra.cast("array<string>"), ",")
    )
    return F.when((F.size(missing) > 0) | (F.size(extra) > 0), result("fail", detail)).otherwise(result("pass"))


def business_dedupe(vendor: Column, number: Column, other: Column) -> Column:
    """``other`` is the least complete document of this vendor and number."""
    given = (F.length(vendor.cast("string")) > 0) & (F.length(number.cast("string")) > 0)
    return (
        F.when(~F.coalesce(given, F.lit(False)), result("not_applicable"))
        .when(other.isNotNull(), result("fail", other.cast("string")))
        .otherwise(result("pass"))
    )


def blocked(gates: dict[str, Column]) -> Column:
    """Whether a blocking gate fails or is inconclusive."""
    tests = [gates[k]["outcome"] == "fail" for k in BLOCKING] + [gates[k]["outcome"] == "inconclusive" for k in BLOCKING_INCONCLUSIVE]
    told = tests[0]
    for t in tests[1:]:
        told = told | t
    return told


def score(outcome: Column) -> Column:
    """Number of an outcome; null for not_applicable."""
    told = F.when(outcome == "pass", SCORES["pass"])
    for k in ("fail", "inconclusive"):
        told = told.when(outcome == k, SCORES[k])
    return told
