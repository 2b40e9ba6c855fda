"""Text, money and path expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and shapes of the fields read from document text.
FIELD_PATTERNS = {
    "invoice_no": r"Invoice No:\s*([A-Za-z0-9\-]+)",
    "invoice_date": r"Invoice Date:\s*(\d{4}-\d{2}-\d{2})",
    "due_date": r"Due Date:\s*(\d{4}-\d{2}-\d{2})",
    "seller": r"Seller:\s*([^\n]+)",
    "buyer": r"Buyer:\s*([^\n]+)",
    "currency": r"Currency:\s*([A-Z]{3})",
    "iban": r"IBAN:\s*([A-Za-z0-9]+)",
}
MONEY_LABELS = {"total_cents": "Total", "subtotal_cents": "Subtotal", "tax_cents": "Tax"}
LINE_ITEM = r"Line Item:\s*([^\n]+?)\s*\|\s*(\$?-?[\d,]+\.\d{2})"
#: Space separators (Zs), which DuckDB's trim strips.
BLANKS = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
ALLOWED_TYPES = ("application/pdf", "image/jpeg", "image/png", "image/tiff")


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it occurs there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def contains_ignoring_case(text: Column, part: Column) -> Column:
    return F.contains(F.lower(text), F.lower(part))


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null where there is none."""
    return bind(F.trim(F.regexp_extract(text, pattern, group)), lambda x: F.when(x != "", x))


def cents(money: Column) -> Column:
    """Cents of an amount such as ``$1,234.50``, ``-3.00`` or ``(3.00)``."""

    def signed(bare: Column) -> Column:
        whole = (F.regexp_replace(bare, r"[()\-,]", "").try_cast("decimal(20,2)") * 100).cast("long")
        return whole * F.when(bare.startswith("(") | bare.startswith("-"), -1).otherwise(1)

    return bind(F.trim(F.regexp_replace(F.trim(money), r"^\$+", "")), signed)


def labelled_cents(text: Column, label: str) -> Column:
    """Cents of the first amount after ``label:``, null where there is none."""
    return cents(found(text, label + r":\s*(\$?\(?-?[\d,]+\.\d{2}\)?)"))


def line_items(text: Column) -> Column:
    """array<struct<description, amount_cents>> of all line items, in order."""
    both = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(LINE_ITEM), F.lit(1)).alias("d"), F.regexp_extract_all(text, F.lit(LINE_ITEM), F.lit(2)).alias("a")
    )
    return F.transform(both, lambda x: F.struct(F.trim(x["d"]).alias("description"), cents(x["a"]).alias("amount_cents")))


def money_renderings(value: Column) -> Column:
    """The four ways in which an amount of cents may be written."""
    exact = value.cast("decimal(20,0)") / 100
    plain = exact.cast("decimal(20,2)")
    size = F.abs(plain)
    grouped = lambda d: F.format_number(d, 2)
    return F.array(plain.cast("string"), grouped(plain), size.cast("string"), F.concat(F.lit("("), grouped(size), F.lit(")")))


def doc_type(text: Column) -> Column:
    low = F.lower(text)
    return F.when(F.contains(low, F.lit("credit memo")), "credit_memo").when(F.contains(low, F.lit("receipt")), "receipt").otherwise("invoice")


def has_text_layer(sample: Column, least: int = 5) -> Column:
    """Loose hint: a few characters, blanks of any script at the ends aside, and a digit."""
    return F.coalesce((F.length(F.trim(sample, F.lit(BLANKS))) >= least) & sample.rlike("[0-9]"), F.lit(False))


def fields(text: Column) -> Column:
    """The typed record read from a text by its labels."""
    named = {k: found(text, p) for k, p in FIELD_PATTERNS.items()}
    money = {k: labelled_cents(text, label) for k, label in MONEY_LABELS.items()}
    return F.struct(
        doc_type(text).alias("doc_type"),
        *[c.alias(k) for k, c in (named | money).items()],
        bind(line_items(text), lambda items: F.when(F.size(items) > 0, items)).alias("line_items"),
    )


def checksum_id(encoded: Column) -> Column:
    """The identity of an object whose CRC-32C is given in base 64; null stays null."""
    return F.concat(F.lit("crc32c-"), F.lower(F.hex(F.unbase64(encoded))))


# ---- paths ------------------------------------------------------------------


def bucket_of(path: Column) -> Column:
    return found(path, r"^gs://([^/]+)/(.*)$", 1)


def key_of(path: Column) -> Column:
    return found(path, r"^gs://([^/]+)/(.*)$", 2)


def shard_path(doc: Column, index: Column, output: bool = False) -> Column:
    folder, suffix = ("shards_out", "json") if output else ("shards", "pdf")
    return F.concat(F.lit(f"{folder}/"), doc.cast("string"), F.lit("/"), F.lpad(index.cast("string"), 4, "0"), F.lit(f".{suffix}"))


def assembled_path(doc: Column) -> Column:
    return F.concat(F.lit("ocr/"), doc.cast("string"), F.lit(".json"))


def page_range(count: Column) -> Column:
    """0 .. count - 1; empty for 0 and null."""
    return F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
