import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from docquarry.llm import repeats
from tests.llm import cases


def brute(texts: list[bytes]) -> list[tuple]:
    counts = Counter(t[p : p + repeats.LENGTH] for t in texts for p in range(len(t) - repeats.LENGTH + 1))
    out = []
    for t in texts:
        covered = np.zeros(len(t) + 1, np.int64)
        for p in range(len(t) - repeats.LENGTH + 1):
            if counts[t[p : p + repeats.LENGTH]] > 1:
                covered[p : p + repeats.LENGTH] = 1
        kept = bytes(b for b, c in zip(t, covered, strict=False) if not c)
        spans = int((np.diff(covered, prepend=0) == 1).sum())
        out.append((len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed: int = 6) -> list[str]:
    rng = random.Random(seed)
    shared = [cases.prose(rng, n) for n in (60, 90, 130, 400)]
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(shared)
            a = rng.randrange(len(p) // 2)
            parts += [cases.prose(rng, rng.randrange(60)), p[a : a + rng.randrange(350, 1200)]]
        texts.append("".join(parts))
    texts += ["ab" * 900, "q" * 1200, "q" * 401, "q" * 399, "é" * 500, shared[3] + shared[3], "z" * 400, "z" * 399 + "y"]
    return texts


def check(spark, texts):
    docs = cases.frame(spark, texts)
    rows = [(r[1] or "").encode() for r in cases.rows(texts)]
    wanted = Counter(brute(rows))
    got = []
    for r in repeats.remove_repeats(docs).collect():
        removed = sum(s["end"] - s["start"] for s in r["spans"])
        got.append((r["n_bytes"], removed, len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()))
    assert Counter(got) == wanted
    return wanted


def test_equals_brute_force(spark):
    wanted = check(spark, passages())
    assert len({w[2] for w in wanted}) > 2


def test_pieces_and_small_parts_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 1000)
    monkeypatch.setattr(repeats, "PART", 5)
    check(spark, passages(7))


@pytest.mark.parametrize("data", [b"", b"a" * 399, b"a" * 400, bytes(range(256)) * 20, b"ab" * 1000])
def test_every_string_has_its_least_gram(data):
    found = np.frombuffer(data, np.uint8)
    first, last, sample = repeats.sample_runs(found, np.array([0]), np.array([len(found)]))
    starts = [p for a, b in zip(first, last, strict=True) for p in range(a, b + 1)]
    assert starts == list(range(len(data) - repeats.LENGTH + 1))
    assert all(b <= s < a + repeats.REACH for a, b, s in zip(first, last, sample, strict=True))


def test_no_rows_and_no_repeats(spark):
    assert repeats.remove_repeats(cases.empty(spark)).count() == 0
    docs = spark.createDataFrame([(1, "short"), (2, None), (2, None)], "doc_id long, text string")
    assert [len(r["spans"]) for r in repeats.remove_repeats(docs).collect()] == [0, 0, 0]
