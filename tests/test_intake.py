"""Work of the intake: spread over tasks, and in proportion to a file's size."""

import random
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import functions as F

from docquarry.functions import crc32c
from docquarry.plans import uploads
from docquarry.plans.queries import QUERIES, SQL
from docquarry.sources import batches, pdf
from docquarry.streaming import intake


def test_objects_of_a_batch_are_read_by_many_tasks(spark, tmp_path, monkeypatch):
    """Names are small: 400 of them would go to one task, and with them all objects."""
    inbox, seen = tmp_path / "inbox", []
    inbox.mkdir()
    for k in range(400):
        (inbox / f"{k}.pdf").write_bytes(pdf.make_pdf([f"No {k}"]))
    spark.range(400).select(F.format_string("%d.pdf", "id").alias("path")).coalesce(1).write.parquet(f"file://{tmp_path}/told")
    taken_in = intake.taken_in

    def watched(files, *rest):
        seen.append(files.groupBy(F.spark_partition_id().alias("task")).count().collect())
        return taken_in(files, *rest)

    monkeypatch.setattr(intake, "taken_in", watched)
    told = spark.readStream.schema("path string").parquet(f"file://{tmp_path}/told")
    intake.run_intake(told, f"file://{inbox}", f"file://{tmp_path}/tables", f"file://{tmp_path}/checkpoint").awaitTermination()
    assert len(seen[0]) == 4 and sum(r["count"] for r in seen[0]) == 400
    assert batches.read_batches(spark, f"file://{tmp_path}/tables", "documents", intake.TABLES["documents"]).count() == 400


def test_an_object_stream_is_opened_once(monkeypatch):
    made, opened, decoded = pdf.make_pdf(["page 1"] * 300, compact=True), [], pdf.decoded

    def counted(stream):
        opened.append(stream.head.get("Type"))
        return decoded(stream)

    monkeypatch.setattr(pdf, "decoded", counted)
    assert pdf.facts(made) == (False, None, 300, "page 1\npage 1\npage 1")
    assert opened.count("ObjStm") == 1


def test_checksums_do_not_depend_on_how_values_are_put_together(monkeypatch):
    rng = random.Random(5)
    values = [rng.randbytes(rng.choice([0, 1, 63, 64, 65, 3000])) for _ in range(300)]
    alone = [int(crc32c.of_bytes([v])[0]) for v in values]
    for together in (1, 700, 1 << 20):
        monkeypatch.setattr(crc32c, "TOGETHER", together)
        assert crc32c.of_bytes(values).tolist() == alone


def test_tables_and_numbers_that_are_not_as_they_should_be():
    """Entries of 19 bytes, numbers and names with something behind them."""
    made = pdf.make_pdf(["a 1", "b 2"])
    assert pdf.facts(made.replace(b" n \n", b" n\n")).page_count == 2
    values = {b"/A#42C": "ABC", b"12.5.6": b"12.5.6", b"-3]": -3, b"+.5 ": 0.5, b"7 0 R": pdf.Ref(7), b"7 0 Rx": 7, b"% c\n/N": "N", b"<4 1#4>": b"A@", b"(a\\(b(c)\\101)": b"a(b(c)A"}
    assert {k: pdf.Lexer(k).value() for k in values} == values


def test_files_are_about_as_long_as_their_texts_and_mislead_nobody():
    text = "Une facture, n° 17 (payée).\r\n" * 12
    assert len(pdf.make_pdf([text] * 20)) < 2 * 20 * len(text)
    odd = ["þÿ 1", "日本(\\)", "a\r\nb\rc\n", "()\\)(", "1 0 obj", "%%EOF", "trailer <</Root 9 0 R>>", "endstream 5", "\u6f62\u6a20", "\\101", "é" * 400]
    for compact in (False, True):
        made = pdf.make_pdf(odd, compact)
        for data in (made, made.replace(b"startxref\n", b"startxref\n9")):
            assert pdf.facts(data, len(odd)) == (False, None, len(odd), "\n".join(odd))
        assert pdf.facts(pdf.make_pdf(["%%EOF"] * 9, compact)[:-60]).damage == "no end marker"


def test_odd_uploads_are_as_in_sql(spark, tmp_path, monkeypatch):
    """Ids that are negative, very large, null or there twice; texts that are null, empty or
    begin like other files; blanks of other scripts; messages in more files than a batch
    commonly takes."""
    same, big = "Invoice No: 17 is the same", 10**13
    rows = [(-k, same) for k in range(1, 60)] + [(10**12 + k * (big - 10**12) // 40, same) for k in range(400)]
    rows += [(3, "twice 1"), (3, "twice 1"), (3, "twice 2"), (18, "cut"), (18, "cut"), (-(1 << 63), "least"), ((1 << 63) - 1, "most 123"), (None, "no id 1"), (None, "no id 2")]
    rows += [(11 * k + 1, text) for k, text in enumerate([None, "", "%PDF-1.4", "II*\0", "MM\0*", "﻿﻿"], 300)] + [(23 * 11, None), (24, ""), (25, None)]
    rows += [(6 * 11 * 7 + 3 + 77 * k, text) for k, text in enumerate(["　　　1 ", "  1234", "\t123\n", "　a1b2c ", "​123​"])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    told, subscribe = [], uploads.subscribe

    def few(session, root, topics, files_per_batch=1):
        told.append(len(list(Path(root.removeprefix("file:")).rglob("*.parquet"))))
        return subscribe(session, root, topics, files_per_batch)

    monkeypatch.setattr(uploads, "subscribe", few)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "50")
    try:
        found = QUERIES["stream_intake"](spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert told[0] > 5
    assert Counter(map(tuple, found)) == Counter(con.sql(SQL["stream_intake"]).fetchall())
    files = [tuple(r) for r in QUERIES["inspect_bytes"](spark, str(tmp_path)).collect()]
    assert Counter(files) == Counter(con.sql(SQL["inspect_bytes"]).fetchall())
