"""The corpus pipeline: five training-data operators applied one after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns
is written as Parquet and read again as the next one's docs.  All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docquarry.llm import decontam, mixing, neardup, pii, quality
from docquarry.llm.common import table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below its threshold go.

    It is fitted anew on the labelled rows of ``docs``; without any, the score is
    constant and all stay or go alike.  Null texts are scored as empty, repeated
    rows alike, very long texts by all their chunks; columns of any name are kept,
    and no rows give no rows."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: that of the least id
    (null last), of equal ids the least MD5 of the text, of equal rows one.  Null
    texts are copies of empty ones, very long ones are compared whole; columns of
    any name are kept, and no rows give no rows."""
    return neardup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, all rows with such a text at once.
    Null and empty texts stay, as does everything if there are no items.  Very
    long texts are looked through whole, repeated rows stay or go alike, columns
    of any name are kept; no rows give no rows."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind, and ``n_chars`` counted anew
    where that changed a text.  Null texts stay null; rows, repeated ones too, and
    columns of any name stay; very long texts are read whole; no rows give none."""
    return pii.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources meet their targets: a
    row per copy, numbered by ``copy`` (``mix_copy`` and so on if there is such a
    column).  A null source is a source, a null id draws by its text, repeated rows
    draw alike, very long texts are counted whole; no rows give no rows."""
    return mixing.emit_mixture(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("pii", personal_data_stage),
    ("mixing", mixing_stage),
]

#: Trained filters, MinHash and token templates have no SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for position, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if position + 1 < len(STAGES):
            docs = written(docs, f"stage-{position}-{name.replace(' ', '-')}")
    return docs
