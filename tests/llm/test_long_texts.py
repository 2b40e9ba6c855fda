"""Texts of several MB among short ones: whole results, by plain means."""

import random

import pytest

from docquarry.llm import chat, decontam, media, pii, quality, repeats, secrets, tokens
from tests.llm import cases
from tests.llm.test_pii import brute as personal

RNG = random.Random(31)
BODY = cases.prose(RNG, 40_000)
ITEM = " ".join(f"question{k} word{k}" for k in range(20))
#: About 4 MB; what is looked for stands at the very end.
LONG = "\n".join(f"{BODY} {k}" for k in range(14)) + f"\n{ITEM} mail last.one@mail.example token = 'abcdefgh1234'"
OTHER = cases.prose(random.Random(32), 500_000)
ROWS = [(1, LONG), (2, OTHER), (3, "short text"), (4, None), (5, "word " * 800_000)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3).cache()


def test_leaks(spark, docs):
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    assert [(r["doc_id"], r["kind"]) for r in decontam.find_leaks(docs, bench).collect()] == [(1, "exact")]


def test_personal(docs):
    got = {r["doc_id"]: [(s["start"], s["kind"], s["end"]) for s in r["found"] if s["kind"] < 4] for r in pii.find_personal(docs).collect()}
    assert got == {i: personal(t or "") for i, t in ROWS} and len(got[1]) == 1


def test_secrets(docs):
    got = {r["doc_id"]: r["found"] for r in secrets.scan_secrets(docs).collect()}
    assert len(got[1]) == 1 and LONG[got[1][0]["start"] : got[1][0]["end"]].startswith("token") and not any(got[k] for k in (2, 3, 4, 5))


def test_repeats(docs):
    got = {r["doc_id"]: sum(s["end"] - s["start"] for s in r["spans"]) for r in repeats.remove_repeats(docs).collect()}
    # each of the fourteen copies of the body, with the blank and line end around it that all share
    assert got[1] >= 14 * len(BODY) and got[1] <= len(LONG) - len(ITEM) and got[5] == len(ROWS[4][1]) and got[2] == got[3] == got[4] == 0


def test_tokens(docs):
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(docs).collect()}
    plain = tokens.load_encoding()
    assert got == {i: len(plain.encode_ordinary(t or "")) for i, t in ROWS}


def test_an_unbroken_piece(spark):
    text = "a" * 20_000 + "é" * 5_000
    got = tokens.count_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()["n_tokens"]
    assert got == len(tokens.load_encoding().encode_ordinary(text))


def test_media_and_scores(spark, docs):
    for r in media.audio_columns(docs, with_media=False).collect():
        n = len((dict(ROWS)[r["doc_id"]] or "").encode())
        assert r["n_bytes"] == n and r["payload_bytes"] == max(1, -(-n // media.UNIT)) * media.UNIT
    sample = [([b"good words and more " * 10], 1), ([b"BAD!! WORDS!! " * 12], 0)] * 20
    model = quality.train(sample, 0.5)
    scores = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, model).collect()}
    assert len(scores) == len(ROWS) and all(0 <= s <= 1 for s in scores.values())


def test_chat(spark):
    frame = spark.createDataFrame([(1, 0, "user", OTHER), (1, 1, "assistant", LONG)], "conv_id long, turn long, role string, text string")
    row = chat.format_conversations(frame).first()
    assert chat.read_back(row["formatted"]) == [("user", OTHER), ("assistant", LONG)]
    a, b = row["loss"][0]
    assert chat.UNESCAPE(row["formatted"][a:b]) == LONG and len(row["loss"]) == 1


def test_patterns_are_linear():
    for text in ("1234-" * 400_000, "a@" * 500_000, "w1 " * 300_000):
        assert isinstance(pii.graph_edges(text, pii.base_spans(text)), list)
