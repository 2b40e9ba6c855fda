"""The folder that the driver and all executors share."""

from __future__ import annotations

from pyspark.sql import SparkSession

from docquarry.sources.objects import delete_prefix


def shared_dir(spark: SparkSession) -> str:
    """Where this application keeps intermediate tables.

    ``spark.checkpoint.dir`` names the shared folder on a cluster.  Only where
    Spark runs in one process, as in tests, the warehouse stands in for it; else
    a missing setting is an error, since executors would write where nobody else
    can read.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{found.rstrip('/')}/docquarry-{spark.conf.get('spark.app.id', 'app')}"


def clear_shared(spark: SparkSession) -> bool:
    """Remove this application's intermediate tables.  Results are lazy and read
    them, so write results first."""
    return delete_prefix(spark, shared_dir(spark))
