"""Runs against a scan of every period, and the query against plain Python."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from docquarry.llm import runs
from tests.llm import cases


def brute(words, shortest=24, times=3):
    """(start, period, length) by comparing the words with themselves, period by period."""
    w, found = np.asarray(words), []
    for p in range(1, len(w) // times + 1):
        edges = np.diff(np.concatenate([[0], (w[:-p] == w[p:]).astype(int), [0]]))
        for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True):
            length = int(b - a + p)
            smaller = any(p % q == 0 and np.array_equal(w[a : a + length - q], w[a + q : a + length]) for q in range(1, p))
            if length >= max(shortest, times * p) and not smaller:
                found.append((int(a), p, length))
    return sorted(found)


def wanted(doc_id, text):
    """The row of the query, word for word."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    number = {}
    found = brute([number.setdefault(w, len(number)) for w in words])
    gone = {i for a, p, length in found for i in range(a + p, a + length)}
    best = min(found, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    told = "".join(f"{a},{length},{p}\n" for a, p, length in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    start, period, length = best or (None, None, None)
    ex = best and 1000 * length // period
    return (doc_id, len(found), start, length, period, ex, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize(("shortest", "times"), [(24, 3), (1, 2), (6, 3), (10, 5)])
def test_runs_equal_a_scan_of_all_periods(shortest, times):
    rng = random.Random(shortest)
    for _ in range(150):
        docs = []
        for _ in range(rng.randrange(1, 6)):
            letters, n = rng.randrange(1, 4), rng.randrange(80)
            doc = [rng.randrange(letters) for _ in range(n)]
            if n > 4 and rng.random() < 0.6:
                a, p = rng.randrange(n), rng.randrange(1, 8)
                doc = [x if i < a else doc[min(n - 1, a + (i - a) % p)] for i, x in enumerate(doc)]
            docs.append(doc + doc[: rng.randrange(n + 1)] + doc if rng.random() < 0.3 else doc)
        counts = np.array([len(d) for d in docs])
        got = [[] for _ in docs]
        for t, start, length, period in zip(*(x.tolist() for x in runs.find_runs(np.array([x for d in docs for x in d], np.int64), counts, shortest, times)), strict=True):
            got[t].append((start, period, length))
        assert got == [brute(d, shortest, times) for d in docs]


def test_suffix_ranks_and_next_smaller_values():
    rng = np.random.default_rng(2)
    for n in (1, 2, 17, 300):
        words = rng.integers(0, 2, n)
        symbols, _ = runs._closed(words, np.array([n]))
        rank, _ = runs.inverse_suffix_array(symbols)
        order = sorted(range(n + 1), key=lambda i: symbols[i:].tolist())
        assert [order.index(i) for i in range(n + 1)] == rank.tolist()
        after = runs.Minima(rank).next_smaller(np.arange(n + 1)).tolist()
        assert after == [next((j for j in range(i + 1, n + 1) if rank[j] < rank[i]), n + 1) for i in range(n + 1)]


def test_the_query_equals_plain_python(spark, tmp_path):
    phrase = " ".join(f"w{k}" for k in range(9))
    texts = [
        "a " * 23, "a " * 24, "b " + "a\t" * 30 + "b", ("x y z\n" * 12) + "x", (phrase + " ") * 3, (phrase + " ") * 2 + phrase[:-3],
        ("a a b " * 9) + ("a b " * 15), " ".join(f"{k}" for k in range(60)) + " same" * 40 + " and more", "ü é " * 20 + " " + "日 本 " * 13,
    ]
    # ids whose CRC-32 asks for a repetition, on texts of all kinds
    chosen = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(i, t) for i, t in enumerate(texts, 1000)] + [(i, t) for i, t in zip(chosen, (texts + ["", None, "one", cases.prose(random.Random(1), 700)]) * 3, strict=False)]
    rows += [r[:2] for r in cases.rows()]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in runs.op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((wanted(i, t) for i, t in rows), key=str)
    assert {r[0]: r[1] for r in got}[1001] == 1 and {r[0]: r[1] for r in got}[1000] == 0


def test_rows_of_any_kind(spark):
    schema = "doc_id long, words array<string>, runs string, kept int"
    rows = [(1, ["a"] * 30, "x", 1), (1, ["a"] * 30, "y", 2), (None, None, None, None), (2, [], None, None), (3, [None, ""] * 15, None, None)]
    got = sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], [tuple(x) for x in r["kept"]]) for r in runs.periodic_runs(spark.createDataFrame(rows, schema)).collect()), key=str)
    one = (1, [(0, 30, 1)], [(0, 1)])
    assert got == sorted([one, one, (None, [], []), (2, [], []), (3, [(0, 30, 1)], [(0, 1)])], key=str)
    assert runs.periodic_runs(spark.createDataFrame([], schema)).count() == 0
    with pytest.raises(ValueError, match="two periods"):
        runs.periodic_runs(spark.createDataFrame([], schema), times=1)


def test_long_texts(spark):
    """Runs of a length at which anything quadratic would not end."""
    rng = random.Random(4)
    head = [f"w{rng.randrange(5000)}" for _ in range(150_000)]
    rows = [(1, ["a"] * 400_000), (2, head + (head[:1000] * 200)), (3, head)]
    got = {r["doc_id"]: ([tuple(x) for x in r["runs"]], [tuple(x) for x in r["kept"]]) for r in runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, words array<string>")).collect()}
    assert got[1] == ([(0, 400_000, 1)], [(0, 1)])
    assert got[3] == ([], [(0, 150_000)])
    (found,), kept = got[2]
    assert found[2] == 1000 and found[0] + found[1] == 350_000 and found[0] <= 150_000 and kept == [(0, found[0] + 1000)]
