"""Assembled texts and shard outputs as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.sources.objects import exists

PAGES = "array<struct<page_no:int,text:string,confidence:double>>"
ASSEMBLED = f"doc_id string, producer string, producer_version string, pages {PAGES}"
SHARD = f"doc_id string, shard_idx int, pages {PAGES}"


def write_artifacts(frame: DataFrame, folder: str) -> None:
    """Written anew as a whole, so a repeated write leaves the same files' rows."""
    frame.write.mode("overwrite").json(folder)


def read_artifacts(spark: SparkSession, folder: str, schema: str = ASSEMBLED) -> DataFrame:
    """Empty where nothing was written yet."""
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(folder)


def assemble_outputs(outputs: DataFrame, producer: str, version: str = "v1") -> DataFrame:
    """Assembled artifacts of shard outputs: all pages in order of their number."""
    flat = outputs.select("doc_id", F.explode("pages").alias("p"))
    return flat.groupBy("doc_id").agg(F.array_sort(F.collect_list("p")).alias("pages")).select(
        "doc_id", F.lit(producer).alias("producer"), F.lit(version).alias("producer_version"), "pages"
    )
