import re
from collections import defaultdict

import pytest

from docquarry.llm import mixing
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reshared(sizes: dict) -> dict:
    """Targets by giving out shares and resharing the excess again and again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3.0 * sizes[s] for s in over}


def check(docs):
    got = mixing.mix_sources(docs, keep=("doc_id", "source", "text")).collect()
    sizes = defaultdict(int)
    for r in got:
        assert r["size"] == len(WORD.findall(r["text"] or ""))
        sizes[r["source"]] += r["size"]
    wanted = reshared(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(wanted[r["source"]] if r["source_size"] else 0)
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert r["copies"] in (int(rate + 1e-9), int(rate + 1e-9) + (rate % 1 > 0)) and r["copies"] <= 3
    return got


def test_targets_equal_repeated_resharing(spark):
    assert len(check(cases.frame(spark))) == len(cases.rows())


@pytest.mark.parametrize("sizes", [[1, 1, 1000], [5, 5, 5], [900, 1, 1, 1, 40], [0, 3, 0], [1] * 7 + [5000], [10, 400, 3, 77, 2000, 1]])
def test_caps_bind(spark, sizes):
    data = [(i, "w " * n, f"src{i}", "x") for i, n in enumerate(sizes)]
    check(spark.createDataFrame(data, "doc_id long, text string, source string, target string").drop("target"))


def test_taken_words_come_near_targets(spark):
    data = [(i, "w " * (5 + i % 11), f"s{min(i % 10, 3)}") for i in range(20000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string")
    taken, target = defaultdict(int), {}
    for r in mixing.mix_sources(docs, keep=("source",)).collect():
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] for s in target)


def test_emission_is_the_mixture_and_reruns_agree(spark):
    docs = cases.frame(spark)
    copies = sorted(mixing.mix_sources(docs).collect(), key=repr)
    assert copies == sorted(mixing.mix_sources(docs.repartition(5)).collect(), key=repr)
    emitted = mixing.emit_mixture(docs)
    assert emitted.columns == docs.columns + ["mix_copy"]
    assert emitted.count() == sum(r["copies"] for r in copies)


def test_no_rows(spark):
    assert mixing.mix_sources(cases.empty(spark)).count() == 0
    assert mixing.emit_mixture(cases.empty(spark)).count() == 0
