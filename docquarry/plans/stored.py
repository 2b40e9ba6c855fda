"""Tables that several queries share, kept by an explicit step."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docquarry.sources.objects import exists, file_facts, rename
from docquarry.sources.shared import shared_dir


def _folder(spark: SparkSession, name: str, inputs: list[str]) -> str:
    facts = repr([file_facts(spark, path) for path in inputs])
    return f"{shared_dir(spark)}/{name}-{hashlib.sha256(facts.encode()).hexdigest()[:32]}"


def keep(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], DataFrame]) -> DataFrame:
    """Work out what ``build`` gives and keep it in the shared folder, for the very files
    that ``inputs`` hold now (by path, length and time).  A table appears whole, by a
    rename, so readers never see a part of it."""
    folder = _folder(spark, name, inputs)
    if not exists(spark, folder):
        fresh = f"{folder}-{uuid.uuid4().hex}"
        build().write.parquet(fresh)
        if not rename(spark, fresh, folder):
            folder = fresh
    return spark.read.parquet(folder)  # its files have the schema, so the plan is not made again


def kept_or(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], DataFrame]) -> DataFrame:
    """What was kept, or else ``build`` as the plan it is: nothing is run here."""
    folder = _folder(spark, name, inputs)
    return spark.read.parquet(folder) if exists(spark, folder) else build()
