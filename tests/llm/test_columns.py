"""Extra columns of any name come through operators and stages as they were."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docquarry.llm import decontam, mixing, neardup, pii, quality
from tests.llm import cases
from tests.llm.test_pipeline import inputs

#: Names that operators use inside, names of their results, and names that need quoting.
NAMES = [
    *(f"_dq_{c}" for c in ("key", "own", "class", "doc", "best", "id", "rows", "size", "source", "unit", "named", "target", "copies", "source_size", "leaked", "score", "found", "text", "row", "base", "edges")),
    "_dq_kept0", "_dq_kept7", "copy", "mix_copy", "score", "component", "node", "bucket", "a.b", "with `tick", "ÜML",
]


def clashing(docs):
    named = [F.concat(F.lit(f"{k}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(n) for k, n in enumerate(NAMES)]
    return docs.select("doc_id", "text", "lang", "source", "n_chars", *named)


def intact(row):
    told = "-" if row[0] is None else str(row[0])
    return [row[5 + k] for k in range(len(NAMES))] == [f"{k}:{told}" for k in range(len(NAMES))]


@pytest.fixture(scope="module")
def docs(spark):
    return clashing(cases.frame(spark, ["mail me at someone@example.org now"] * 3)).cache()


def test_one_of_each_class(docs):
    kept, plain = neardup.keep_one(docs), neardup.keep_one(docs.select("doc_id", "text"))
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert all(map(intact, rows)) and sorted(map(str, plain.collect())) == sorted(map(str, kept.select("doc_id", "text").collect()))


def test_mixture(docs):
    mixed = mixing.emit_mixture(docs)
    assert mixed.columns == [*docs.columns, "mix_copy_"]
    rows = mixed.collect()
    assert rows and all(map(intact, rows))
    told = mixing.mix_sources(docs, keep=("doc_id", "_dq_size", "copy"))
    assert told.columns == ["doc_id", "_dq_size", "copy", "size", "source_size", "target", "copies"] and told.count() == docs.count()


def test_leaks(spark, docs):
    bench = spark.createDataFrame([(1, cases.prose(__import__("random").Random(3), 40))], "item_id long, text string")
    left = decontam.drop_leaks(docs, bench)
    assert left.columns == docs.columns and all(map(intact, left.collect()))


def test_redaction(docs):
    safe = pii.redact(docs)
    rows = safe.collect()
    assert safe.columns == docs.columns and len(rows) == docs.count() and all(map(intact, rows))
    assert sum("[EMAIL]" in (r["text"] or "") for r in rows) == 3


def test_scores(docs):
    model = quality.train([([b"good words and more " * 10], 1), ([b"BAD!! WORDS!! " * 12], 0)] * 20, 0.5)
    good = quality.keep_good(docs, model)
    rows = good.collect()
    assert good.columns == docs.columns and rows and all(map(intact, rows))
    assert len(rows) == quality.score_quality(docs, model, ("doc_id",), "_dq_score").where("_dq_score >= 0.3").count()


def test_stages(spark, docs, tmp_path):
    inputs(spark, str(tmp_path))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns + ["mix_copy_"] * (k == 4)
        assert all(map(intact, out.collect()))
