"""Triage from bytes: generated files, odd and broken ones among them."""

import base64
import json
import random
import zlib

import pytest
from pyspark.sql import functions as F

from docquarry.functions import crc32c
from docquarry.plans.triage import triage
from docquarry.sources import batches, objects
from docquarry.sources.blobs import with_object_ids, write_blobs
from docquarry.sources.inspect import inspect_prefix, sniffed_type
from docquarry.sources.pdf import Facts, facts, make_pdf
from docquarry.streaming import intake


def handmade(objects, trailer="<</Root 1 0 R>>", before=b"", prev=None):
    """A file of numbered objects with a classic table; ``before`` is an older file."""
    out, at = bytearray(before or b"%PDF-1.4\n"), {}
    for n, body in objects.items():
        at[n] = len(out)
        out += b"%d 0 obj\n" % n + body + b"\nendobj\n"
    start = len(out)
    out += b"xref\n"
    for n in sorted(at):
        out += b"%d 1\n%010d 00000 n \n" % (n, at[n])
    told = trailer if prev is None else trailer[:-2] + f"/Prev {prev}>>"
    return bytes(out) + b"trailer\n" + told.encode() + b"\nstartxref\n%d\n%%%%EOF\n" % start


def stream(data, extra=b""):
    return b"<</Length %d%s>>\nstream\r\n" % (len(data), extra) + data + b"\nendstream"


NESTED = {
    1: b"<< /Type /Catalog /Pages 2 0 R >> % a comment",
    2: b"<</Type/Pages/Kids[3 0 R 4 0 R]/Count 3>>",
    3: b"<</Type/Pages/Kids[5 0 R 6 0 R]/Count 2>>",
    4: b"<</Type/Page/Contents[9 0 R 8 0 R]>>",
    5: b"<</Type/Page/Contents 7 0 R>>",
    6: b"<</Type/Page>>",
    7: stream(rb"BT (a \(b\) \\ \101\r) Tj 0 -12 Td [(To) -20 (tal: ) 5 <34322E3030>] TJ ET"),
    8: stream(base64.a85encode(zlib.compress(b"BT (packed 1) Tj ET")) + b"~>", b"/Filter[/ASCII85Decode/FlateDecode]"),
    9: stream(b"q 1 0 0 1 0 0 cm BT <FEFF00E9> Tj ET Q"),
}


def test_trees_strings_and_filters():
    assert facts(handmade(NESTED)) == Facts(False, None, 3, "a (b) \\ A\r\nTotal: 42.00\n\né\npacked 1")
    assert facts(handmade(NESTED), 1).sample == "a (b) \\ A\r\nTotal: 42.00"


def test_a_later_part_replaces_objects_of_an_earlier():
    first = handmade(NESTED)
    start = first.rindex(b"xref\n1 1")
    later = handmade({2: b"<</Type/Pages/Kids[5 0 R]/Count 1>>"}, before=first, prev=start)
    assert facts(later).page_count == 1
    locked = handmade({10: b"<</Filter/Standard>>"}, "<</Root 1 0 R/Encrypt 10 0 R>>", before=first, prev=start)
    assert facts(locked) == Facts(True, None, None, None)


def test_pages_of_both_forms_come_back():
    rng = random.Random(1)
    for compact in (False, True):
        for n in (1, 2, 25, 300):
            pages = ["".join(rng.choice("abc 12\nüé日💡()<>\\%") for _ in range(rng.randrange(300))) for _ in range(n)]
            made = make_pdf(pages, compact)
            assert facts(made, n) == Facts(False, None, n, "\n".join(pages))
            assert facts(make_pdf(pages, compact, encrypted=True)).encrypted
            # a place that is wrong is looked for
            assert facts(made.replace(b"startxref\n", b"startxref\n9"), n) == Facts(False, None, n, "\n".join(pages))


def test_damage_has_a_reason_and_never_raises():
    whole = make_pdf(["some text 1"] * 3)
    assert facts(whole[: len(whole) // 2]).damage == "no end marker"
    assert facts(b"").damage == "no end marker"
    assert facts(b"%PDF-1.4 nothing here %%EOF").damage == "no catalog"
    assert facts(handmade({1: b"<</Type/Catalog/Pages 2 0 R>>", 2: b"<</Kids[2 0 R]>>"})).damage == "pages in a circle"
    assert facts(handmade({1: b"<</Type/Catalog/Pages 2 0 R>>", 2: b"<</Kids[]>>"})).damage == "no pages"
    assert facts(handmade({1: b"2 0 R", 2: b"1 0 R"})).damage
    assert facts(handmade(NESTED | {7: b"<<" * 200})).damage
    rng = random.Random(4)
    for made in (whole, make_pdf(["some text 1"] * 3, compact=True), handmade(NESTED)):
        for _ in range(1500):
            data = bytearray(made)
            for _ in range(rng.randrange(1, 6)):
                data[rng.randrange(len(data))] = rng.randrange(256)
            found = facts(bytes(data))
            assert found.encrypted or (found.damage is None) == (found.page_count is not None)


def test_files_on_disk_are_triaged_by_their_bytes(spark, tmp_path):
    files = {
        "clean.pdf": make_pdf(["Invoice No: 17"]),
        "again.bin": make_pdf(["Invoice No: 17"]),
        "blank.pdf": make_pdf(["", "", ""]),
        "long.pdf": make_pdf(["x"] * 25, compact=True),
        "locked.pdf": make_pdf(["secret"], encrypted=True),
        "cut.pdf": make_pdf(["Invoice No: 17"] * 9)[:900],
        "empty.pdf": b"",
        "note.txt": b"plain text",
        "photo.jpg": b"\xff\xd8\xff\xe0 pixels",
        "scan.tif": b"II*\0 pixels",
        "scan2.tif": b"MM\0* pixels",
        "short.bin": b"\x89P",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    found = inspect_prefix(spark, f"file://{tmp_path}")
    assert "content" not in found.columns
    told = {r["doc_id"].rpartition("/")[2]: r for r in triage(found).collect()}
    assert len(told) == len(files)
    result = {n: r["result"] for n, r in told.items()}
    assert sorted((result.pop("clean.pdf"), result.pop("again.bin"))) == ["dispatched", "duplicate"]
    assert result == {
        "blank.pdf": "dispatched", "long.pdf": "page_ceiling", "locked.pdf": "encrypted", "cut.pdf": "corrupt", "empty.pdf": "zero_byte",
        "note.txt": "unsupported_mime", "short.bin": "unsupported_mime", "photo.jpg": "dispatched", "scan.tif": "dispatched", "scan2.tif": "dispatched",
    }
    assert told["cut.pdf"]["last_error"] == "corrupt_pdf:no end marker" and told["long.pdf"]["last_error"] == "page_ceiling_exceeded:25"
    assert [told[n]["page_count"] for n in ("blank.pdf", "photo.jpg", "locked.pdf", "note.txt")] == [3, 1, None, None]
    assert told["clean.pdf"]["sample"] == "Invoice No: 17" and told["blank.pdf"]["sample"] == "\n\n"


def test_magic_numbers(spark):
    rows = [(b"%PDF-1.7", "application/pdf"), (b"\xff\xd8\xff", "image/jpeg"), (b"\x89PNG\r\n\x1a\n..", "image/png"), (b"\x89PNG\r\n", "application/octet-stream"), (b"", "application/octet-stream")]
    frame = spark.createDataFrame(rows, "content binary, wanted string")
    assert frame.where(sniffed_type(frame["content"]) != frame["wanted"]).count() == 0


# ---- identities ---------------------------------------------------------------


def bitwise(data):
    rest = 0xFFFFFFFF
    for byte in data:
        rest ^= byte
        for _ in range(8):
            rest = (rest >> 1) ^ (0x82F63B78 if rest & 1 else 0)
    return rest ^ 0xFFFFFFFF


def test_checksums_equal_published_ones_and_the_bitwise_loop():
    # the check value of the polynomial, and the vectors of RFC 3720
    published = [(b"123456789", 0xE3069283), (bytes(32), 0x8A9136AA), (b"\xff" * 32, 0x62A8AB43), (bytes(range(32)), 0x46DD794E), (bytes(range(31, -1, -1)), 0x113FDB5C)]
    assert crc32c.of_bytes([d for d, _ in published]).tolist() == [c for _, c in published]
    rng = random.Random(3)
    values = [b"", b"a"] + [rng.randbytes(n) for n in (*range(60, 70), 127, 128, 129, 191, 193, 1000, 20_001)] + [rng.randbytes(rng.randrange(400)) for _ in range(100)]
    sums = crc32c.of_bytes(values).tolist()
    assert sums == [bitwise(v) for v in values] and len(crc32c.of_bytes([])) == 0
    assert crc32c.joined(sums[-1], sums[-2], len(values[-2])) == bitwise(values[-1] + values[-2])


def test_parts_give_the_checksum_of_the_whole(spark):
    rng = random.Random(8)
    wholes = {k: rng.randbytes(rng.randrange(1, 9000)) for k in range(6)}
    parts = [(k, i, w[a : a + 1000]) for k, w in wholes.items() for i, a in enumerate(range(0, len(w), 1000))]
    rng.shuffle(parts)
    frame = spark.createDataFrame(parts, "name long, part int, content binary").withColumn("checksum", crc32c.checksum(F.col("content"))).withColumn("length", F.length("content").cast("long"))
    got = {r["name"]: (r["checksum"], r["length"]) for r in crc32c.whole_checksums(frame, "name", "part").collect()}
    assert got == {k: (bitwise(w), len(w)) for k, w in wholes.items()}


def test_objects_are_written_with_their_identity(spark, tmp_path):
    rows = [("in/a.pdf", b"123456789"), ("in/deep/b.PNG", b""), ("c", bytes(32)), ("none.json", None)]
    frame = spark.createDataFrame(rows, "path string, content binary").repartition(2)
    told = {r["path"]: tuple(r)[1:] for r in write_blobs(frame, f"file://{tmp_path}/store").collect()}
    assert told == {
        "in/a.pdf": (9, "application/pdf", "crc32c-e3069283"), "in/deep/b.PNG": (0, "image/png", "crc32c-00000000"),
        "c": (32, "application/octet-stream", "crc32c-8a9136aa"), "none.json": (None, "application/json", None),
    }
    stored = {p.relative_to(tmp_path / "store").as_posix(): p.read_bytes() for p in (tmp_path / "store").rglob("*") if p.is_file() and not p.name.endswith(".crc")}
    assert stored == {p: c for p, c in rows if c is not None}
    read = with_object_ids(objects.read_objects(spark, f"file://{tmp_path}/store"))
    assert sorted(r["object_id"] for r in read.collect()) == sorted(t[2] for t in told.values() if t[2])
    (tmp_path / "blocked").write_text("a file where a folder should be")
    with pytest.raises(Exception, match="blocked"):
        write_blobs(frame, f"file://{tmp_path}/blocked").collect()


# ---- intake -------------------------------------------------------------------


def test_intake_over_several_batches_and_a_stop(spark, tmp_path, monkeypatch):
    """Copies within and across batches, objects that vanished or were told of twice, and
    a stop behind the rows and before the manifest."""
    inbox, root, source = tmp_path / "inbox", f"file://{tmp_path}/tables", f"file://{tmp_path}/told"
    inbox.mkdir()
    rounds = [
        {"a.pdf": make_pdf(["Invoice No: 17"]), "b.pdf": make_pdf(["Invoice No: 17"]), "scan.pdf": make_pdf(["", ""]), "empty.pdf": b"", "gone.pdf": None},
        {"c.pdf": make_pdf(["Invoice No: 17"]), "d.pdf": make_pdf(["A receipt, No 4"], compact=True), "cut.pdf": make_pdf(["x"])[:100], "cut2.pdf": make_pdf(["x"])[:100]},
    ]

    def tell(files):
        for name, data in files.items():
            if data is not None:
                (inbox / name).write_bytes(data)
        spark.createDataFrame([(n,) for n in [*files, next(iter(files))]], "path string").coalesce(1).write.mode("append").parquet(source)

    def start():
        told = spark.readStream.schema("path string").option("maxFilesPerTrigger", 1).parquet(source)
        intake.run_intake(told, f"file://{inbox}", root, f"file://{tmp_path}/checkpoint").awaitTermination()

    read = lambda name: batches.read_batches(spark, root, name, intake.TABLES[name]).collect()
    tell(rounds[0])
    start()
    assert {r["gcs_path"]: (r["result"], r["state"]) for r in read("documents")} == {
        "a.pdf": ("dispatched", "text_pending"), "scan.pdf": ("dispatched", "text_pending"), "empty.pdf": ("zero_byte", "failed"),
    }
    tell(rounds[1])

    def stopped(*_):
        raise RuntimeError("stopped before the manifest")

    with monkeypatch.context() as broken:
        broken.setattr(batches, "put_if_absent", stopped)
        with pytest.raises(Exception, match="stopped"):
            start()
    assert len(read("documents")) == 3 and len(read("messages")) == 2
    start()
    rows = {r["gcs_path"]: r for r in read("documents")}
    assert len(read("documents")) == len(rows) == 6 and set(rows) == {"a.pdf", "scan.pdf", "empty.pdf", "d.pdf", "cut.pdf", "cut2.pdf"}
    assert rows["cut.pdf"]["result"] == rows["cut2.pdf"]["result"] == "corrupt" and rows["d.pdf"]["doc_type"] == "receipt"
    sent = {json.loads(r["payload"])["gcs_path"]: (r["topic"], r["object_id"]) for r in read("messages")}
    assert {n: t for n, (t, _) in sent.items()} == {"a.pdf": "text.embedded", "scan.pdf": "ocr.split", "d.pdf": "text.embedded"}
    assert sent["a.pdf"][1] == f"crc32c-{bitwise(rounds[0]['a.pdf']):08x}" == rows["a.pdf"]["object_id"]
