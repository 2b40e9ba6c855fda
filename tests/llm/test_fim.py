"""Fill-in-the-middle against the same in plain Python, row by row."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from docquarry.llm import fim
from tests.llm import cases


def plain(doc_id, text, seed="42", rate=50, spm=80, marks=("<P>", "<S>", "<M>")):
    """doc_id, n, form, prefix_chars, middle_chars and output."""
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    key = str(doc_id) if doc_id is not None else "text:" + hashlib.sha256(text.encode()).hexdigest()
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in marks) or h[2] % 100 >= rate:
        return (doc_id, n, "plain", None, None, text)
    prefix, middle, suffix = ("".join(tokens[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    p, s, m = marks
    if h[3] % 100 < spm:
        return (doc_id, n, "spm", len(prefix), len(middle), s + suffix + p + prefix + m + middle)
    return (doc_id, n, "psm", len(prefix), len(middle), p + prefix + s + suffix + m + middle)


def odd_rows():
    rng = random.Random(9)
    texts = ["<P> is a mark", "a<S>b", "<M>", "<P <S <M", "ends with <", "P>S>M>", "nul \0 inside", "\x85\xa0  other blanks", "'; DROP TABLE batch --", "{braces} %s", "\t\r\n lead", "trail \n"]
    rows = [r[:2] for r in cases.rows(texts)]
    for i in range(100, 700):
        rows.append((i, "".join(rng.choice(["a", "ß", "日本", "💡", " ", "  ", "\n", "<", "P", ">", "<S", "M>", "word", "\x0b"]) for _ in range(rng.randrange(40)))))
    return rows


def test_rows_equal_plain_python(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("n", "form", "batch", "tokens", "hex", "output")}).repartition(3)
    got = [tuple(r) for r in fim.fill_in_middle(docs).collect()]
    assert sorted(got, key=str) == sorted((plain(*r) for r in rows), key=str)
    assert {r[2] for r in got} == {"plain", "spm", "psm"}
    assert fim.fill_in_middle(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("rate", "spm", "marks"), [(100, 0, ("<P>", "<S>", "<M>")), (100, 100, ("<fim'p>", "<fim's>", "<fim'm>")), (0, 50, ("<P>", "<S>", "<M>"))])
def test_texts_come_back_from_output_and_form(spark, rate, spm, marks):
    rows = odd_rows()
    docs = spark.createDataFrame([(i if i is not None else -k, t) for k, (i, t) in enumerate(rows)], "doc_id long, text string")
    made = fim.fill_in_middle(docs, seed="it's", rate=rate, spm=spm, marks=marks)
    got = made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fim.restored_text(F.col("output"), F.col("form"), marks).alias("back")).collect()
    want = {repr(plain(i, t, "it's", rate, spm, marks)): t or "" for i, t in [tuple(r) for r in docs.collect()]}
    assert {repr(tuple(r)[:6]): r["back"] for r in got} == want


def test_the_query(spark, tmp_path):
    rows = odd_rows()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    got = [tuple(r) for r in fim.op13_fill_in_middle(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(((*(p := plain(i, t))[:5], sha(p[5]), sha(t or "")) for i, t in rows), key=str)


def test_long_texts(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(cases.prose(rng, 2000) for _ in range(150)) if k else "x" * 5_000_000) for k in range(3)]
    got = {r["doc_id"]: tuple(r) for r in fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), rate=100).collect()}
    assert got == {i: plain(i, t, rate=100) for i, t in rows}
