"""A session that can read and nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docquarry.sources import statements


class Denied(PermissionError):
    pass


class ReadOnlyLedger:
    """What a reporting role may see: named tables and packaged statements.  No
    writer, catalogue or free SQL is within reach."""

    ALLOWED = ("ledger", "document_shards", "feature_flags")

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame]):
        self._spark = spark
        self._tables = {k: v for k, v in tables.items() if k in self.ALLOWED}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            raise Denied(f"no access to {name}")
        return self._tables[name]

    def run(self, file: str, name: str, **args) -> DataFrame:
        return statements.run(self._spark, file, name, self._tables, **args)
