"""Rows of several tables that become visible together.

A batch writes each table's rows into a folder of its own and then puts one
manifest that names the folders.  Readers go by manifests alone, so they see all
of a batch or none of it, whatever a failed attempt has left behind.  A batch is
known by its number, and a number is committed once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.sources.objects import ensure_folder, exists, put_if_absent

MANIFESTS = "manifests"


def _manifest(root: str, number: int, kind: str = "batch") -> str:
    return f"{root}/{MANIFESTS}/{number:020d}.{kind}.json"


def commit_batch(spark: SparkSession, root: str, number: int, tables: dict[str, DataFrame]) -> bool:
    """Append ``tables`` as batch ``number``; false if it was there already, by an
    earlier attempt or by another writer."""
    if exists(spark, _manifest(root, number)):
        return False
    folders = {}
    for name, rows in tables.items():
        folders[name] = f"{name}/{number:020d}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{root}/{folders[name]}")
    return put_if_absent(spark, _manifest(root, number), json.dumps({"number": number, "folders": folders}).encode())


def _committed(spark: SparkSession, root: str) -> list[dict]:
    """The manifests that count: the last compaction and the batches after it."""
    if not exists(spark, f"{root}/{MANIFESTS}"):
        return []
    found = spark.read.schema("value string").option("pathGlobFilter", "*.json").option("wholetext", True).text(f"{root}/{MANIFESTS}")
    told = [json.loads(r["value"]) for r in found.collect()]  # a line for each batch since the last compaction
    whole = max((m for m in told if "upto" in m), key=lambda m: m["upto"], default=None)
    later = [m for m in told if "upto" not in m and (whole is None or m["number"] > whole["upto"])]
    return [*([whole] if whole else []), *sorted(later, key=lambda m: m["number"])]


def _paths(root: str, told: list[dict], name: str) -> list[str]:
    """Where the rows of a table are; a manifest names a folder, or files one by one."""
    named = [m["folders"][name] for m in told if name in m["folders"]]
    return [f"{root}/{p}" for n in named for p in (n if isinstance(n, list) else [n])]


def read_batches(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """All committed rows of table ``name``."""
    folders = _paths(root, _committed(spark, root), name)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def compact_batches(spark: SparkSession, root: str, schemas: dict[str, str], files: int = 8) -> bool:
    """Write the rows of all batches so far once more, in ``files`` files a table, and let
    one manifest stand for theirs.  Readers of the older folders are not disturbed."""
    told = _committed(spark, root)
    if len(told) < 2:
        return False
    upto, folders = max(m.get("number", m.get("upto")) for m in told), {}
    for name, schema in schemas.items():
        folders[name] = f"{name}/{upto:020d}-{uuid.uuid4().hex}"
        older = _paths(root, told, name)
        rows = spark.read.schema(schema).parquet(*older) if older else spark.createDataFrame([], schema)
        rows.repartition(files).write.parquet(f"{root}/{folders[name]}")
    return put_if_absent(spark, _manifest(root, upto, "whole"), json.dumps({"upto": upto, "folders": folders}).encode())


def relay_batches(
    spark: SparkSession, root: str, name: str, schema: str, deliver: Callable[[DataFrame, int], None], checkpoint: str, per_batch: int = 100
):
    """A stream that hands the rows of ``name`` to ``deliver``, of committed batches only
    and in their order.  Where ``deliver`` raises, they come again."""
    ensure_folder(spark, f"{root}/{MANIFESTS}")
    manifests = (
        spark.readStream.schema("value string").option("pathGlobFilter", "*.batch.json").option("wholetext", True)
        .option("maxFilesPerTrigger", per_batch).text(f"{root}/{MANIFESTS}")
    )

    def each(batch: DataFrame, number: int) -> None:
        told = sorted((json.loads(r["value"]) for r in batch.collect()), key=lambda m: m["number"])
        folders = _paths(root, told, name)
        if folders:
            deliver(batch.sparkSession.read.schema(schema).parquet(*folders), number)

    return manifests.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()


def numbered(rows: DataFrame, number: int) -> DataFrame:
    """``rows`` with the number of their batch, for readers that need an order."""
    return rows.withColumn("batch", F.lit(number).cast("long"))
