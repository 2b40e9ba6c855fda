import random
import re

import numpy as np
import pytest

from docquarry.llm import graph, neardup
from tests.llm import cases

WORD = re.compile(r"\w+")


def classes(rows: list[tuple]) -> dict[int, tuple]:
    """Row number to (members of its class, links), from all pairs."""
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").lower())
        k = min(5, len(w))
        sets.append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set())
    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a + 1, n):
            same = (rows[a][1] or "") == (rows[b][1] or "")
            shared = len(sets[a] & sets[b])
            if same or (shared and 5 * shared >= 4 * len(sets[a] | sets[b])):
                links[a] += 1
                links[b] += 1
                parent[find(b)] = find(a)
    out = {}
    for a in range(n):
        members = [x for x in range(n) if find(x) == find(a)]
        ids = [rows[x][0] for x in members if rows[x][0] is not None]
        out[a] = (min(ids, default=None), links[a])
    return out


def families(count: int, seed: int = 8) -> list[str]:
    rng = random.Random(seed)
    texts = []
    for _ in range(count):
        words = cases.prose(rng, rng.choice([6, 30, 120, 300])).split()
        for _ in range(rng.randrange(1, 7)):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 2, max(1, len(copy) // 25), len(copy) // 8])):
                copy[rng.randrange(len(copy))] = "changed" + str(rng.randrange(99))
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


def test_equals_all_pairs(spark):
    texts = families(30)
    docs = cases.frame(spark, texts)
    rows = [(r[0], r[1]) for r in cases.rows(texts)]
    wanted = sorted((rows[k][0] is None, rows[k][0] or 0, c, n) for k, (c, n) in classes(rows).items())
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["class_id"], r["n_links"]) for r in neardup.near_duplicates(docs).collect())
    assert got == wanted
    assert sum(1 for x in wanted if x[3]) > 40


def test_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_DOCS", 7)
    rng = random.Random(3)
    words = cases.prose(rng, 100).split()
    texts = []
    for k in range(60):
        copy = list(words)
        copy[rng.randrange(100)] = f"edit{k}"
        texts.append(" ".join(copy))
    rows = list(enumerate(texts + texts[:5]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in neardup.near_duplicates(docs).collect()}
    assert got == classes(rows) and len({c for c, _ in got.values()}) == 1


def test_keep_one(spark):
    texts = families(12)
    docs = cases.frame(spark, texts)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns
    rows = [(r[0], r[1]) for r in cases.rows(texts)]
    ids = sorted(repr(r["doc_id"]) for r in kept.collect())
    groups = classes(rows)
    by_class = {}
    for k, (c, _) in groups.items():
        by_class.setdefault(repr(c), set()).add(k)
    # one row of each class, and each the least id
    assert len(ids) == len(set(map(repr, (c for c, _ in groups.values())))) + 1  # id 9 names two texts
    assert set(ids) == set(by_class)
    assert neardup.keep_one(cases.empty(spark)).count() == 0
    assert neardup.near_duplicates(cases.empty(spark)).count() == 0


def test_pruning_drops_no_pair_at_the_threshold():
    rng = np.random.default_rng(5)
    left, right, wanted = [], [], set()
    for k in range(60):
        base = np.unique(rng.integers(0, 1 << 63, 90, dtype=np.uint64))
        other = base.copy()
        other[: k % 14] += np.uint64(1)
        left.append(base), right.append(np.unique(other))
        shared = len(np.intersect1d(base, other))
        if 5 * shared >= 4 * (180 - shared):
            wanted.add((k, k))
    a, b = neardup.linked_pairs(left, right)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == wanted and 20 < len(wanted) < 60


def test_least_matches_follow_the_posterior():
    needed = neardup.least_matches(0.8, 1e-3, 10, 20)
    assert 0 < needed[10] < 8 < needed[20] < 16
    assert neardup.least_matches(0.8, 1e-9, 10, 20)[20] < needed[20]


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 3), (None, 3), (9, 8)], [(k, k + 1) for k in range(40)], [(0, k) for k in range(1, 50)]])
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r["node"]: r["component"] for r in graph.components(frame).collect()}
    wanted = {}
    for a, b in edges:
        if a is not None and b is not None:
            wanted.setdefault(a, a), wanted.setdefault(b, b)
    for _ in wanted:
        for a, b in edges:
            if a is not None and b is not None:
                wanted[a] = wanted[b] = min(wanted[a], wanted[b])
    assert found == wanted


def test_chains_are_compared_by_bucket(spark, monkeypatch):
    words = cases.prose(random.Random(11), 1600).split()
    texts = [" ".join(words[6 * k : 6 * k + 100]) for k in range(240)]
    rows = list(enumerate(texts + texts[:3]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    widths = []
    inner = neardup._units
    monkeypatch.setattr(neardup, "_units", lambda *a: (found := inner(*a), widths.extend(len(r["unit"]) for r in found.collect()))[0])
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in neardup.near_duplicates(docs).collect()}
    assert got == classes(rows) and 8 in widths


def test_one_very_long_text(spark):
    rng = random.Random(12)
    long = cases.prose(rng, 400_000)
    rows = [(1, long), (2, long + " end"), (3, cases.prose(rng, 50))]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 0)}
