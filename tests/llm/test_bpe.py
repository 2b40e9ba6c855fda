"""Byte-level BPE against the tiktoken library, and back."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docquarry.llm import bpe
from docquarry.llm.tokens import load_encoding
from tests.llm import cases


@pytest.fixture(scope="module")
def library():
    return load_encoding(bpe.RANKS)


def encoded(texts, path=bpe.RANKS):
    found = bpe.encode_texts(*bpe._texts(pa.array(texts, pa.string())), path)
    at = np.concatenate([[0], np.cumsum(found.counts)])
    return [tuple(x[a:b].tolist() for x in found[1:]) for a, b in zip(at[:-1], at[1:], strict=True)]


def test_every_code_point(library):
    """All planes that have characters whole, of the others every 97th code point."""
    every = [*range(0xD800), *range(0xE000, 0x34000), *range(0x34000, 0xE0000, 97), *range(0xE0000, 0xE1000), *range(0xE1000, 0x110000, 97), 0x10FFFF]
    for k in range(0, len(every), 50_000):
        texts = [f"a{c} {c}1{c}{c}  {c}b'{c}'s" for c in map(chr, every[k : k + 50_000])]
        assert [ids for ids, *_ in encoded(texts)] == library.encode_ordinary_batch(texts)


def odd_texts(library, count, seed):
    rng = random.Random(seed)
    tokens = [library.decode_single_token_bytes(i) for i in range(library.n_vocab - 1)]
    kinds = [
        lambda: "".join(rng.choice("ab -=_.\n") for _ in range(rng.randrange(60))),
        lambda: b"".join(rng.choice(tokens) for _ in range(rng.randrange(12))).decode("utf8", "replace"),
        lambda: "".join(rng.choice("aeinrst") for _ in range(rng.randrange(80))),
        lambda: "".join(rng.choice("'' 'stmdrevl\n\t") for _ in range(rng.randrange(20))),
        lambda: "".join(rng.choice(["  ", "　", "-", "---", "=", "ha", "aa", "\t\t", "\xa0", "'s", "'ll", "é", "日", "💡", "\0", "﷐", "￾"]) * rng.randrange(1, 9) for _ in range(rng.randrange(20))),
    ]
    return [rng.choice(kinds)() for _ in range(count)]


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_any_text(name):
    path = public_tokenizers.path(name)
    library = load_encoding(path)
    texts = odd_texts(library, 20_000, 5)
    assert [ids for ids, *_ in encoded(texts, path)] == library.encode_ordinary_batch(texts)


def test_every_token_alone(library):
    """Ids of tokens that are texts come back, with one exception per text that splits."""
    texts = [library.decode_single_token_bytes(i) for i in range(library.n_vocab - 1)]
    texts = [t.decode() for t in texts if not isinstance(t, str) and b"\xef\xbf\xbd" not in t and t.decode("utf8", "ignore").encode() == t]
    assert [ids for ids, *_ in encoded(texts)] == library.encode_ordinary_batch(texts)


def test_offsets_and_split_characters(library):
    texts = odd_texts(library, 1500, 8) + ["", "💡" * 5, "\U0001f9ff zwölf", ""]
    for text, (ids, starts, ends, split) in zip(texts, encoded(texts), strict=True):
        at = 0
        character = [k for k, c in enumerate(text) for _ in c.encode()]
        whole = {0, *np.cumsum([len(c.encode()) for c in text]).tolist()}
        for i, a, b, s in zip(ids, starts, ends, split, strict=True):
            n = len(library.decode_single_token_bytes(i))
            assert (a, b, s) == (character[at], character[at + n - 1] + 1, at not in whole or at + n not in whole)
            at += n
        parts = bpe.token_texts(ids)
        assert "".join(parts) == text and len(parts) == len(ids)
    assert any(s for *_, split in encoded(texts) for s in split)


def test_decoding_lists_cut_anywhere():
    (ids, *_), = encoded(["a 💡 b 日本 ü"])
    counts = np.array([0, 1, 2, 0, len(ids) - 3])
    data, sizes = bpe.decode_ids(np.array(ids), counts)
    assert data.tobytes().decode() == "a 💡 b 日本 ü" and sizes.sum() == len(data) and sizes[0] == sizes[3] == 0
    for wrong in ([-1], [50_256], [10**6]):
        with pytest.raises(ValueError, match="vocabulary"):
            bpe.decode_ids(np.array(wrong), np.array([1]))


def test_frames(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 500)
    rows = [r[:2] for r in cases.rows(odd_texts(library, 50, 2))]
    docs = cases.frame(spark, odd_texts(library, 50, 2)).withColumns({c: F.lit(1) for c in ("ids", "starts", "ends", "decoded")})
    found = bpe.encode(docs)
    got = sorted(((r["doc_id"], r["ids"], len(r["starts"]), len(r["ends"])) for r in found.collect()), key=str)
    want = [(i, library.encode_ordinary(t or "")) for i, t in rows]
    assert got == sorted(((i, ids, len(ids), len(ids)) for i, ids in want), key=str)
    back = sorted(((r["doc_id"], bytes(r["decoded"])) for r in bpe.decode(found).collect()), key=str)
    assert back == sorted(((i, (t or "").encode()) for i, t in rows), key=str)
    assert bpe.decode(bpe.encode(cases.empty(spark))).count() == 0
    nulls = spark.createDataFrame([(1, None), (None, [])], "doc_id long, ids array<int>")
    assert [bytes(r["decoded"]) for r in bpe.decode(nulls).collect()] == [b"", b""]


def test_the_query(spark, library, tmp_path):
    rng = random.Random(6)
    rows = [r[:2] for r in cases.rows(odd_texts(library, 30, 4))] + [(900, "a" * 20_000 + "é" * 5_000), (901, "\n".join(cases.prose(rng, 3000) for _ in range(200)))]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda data: hashlib.sha256(data).hexdigest()
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert sorted((tuple(r) for r in bpe.op11_byte_bpe(spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)
