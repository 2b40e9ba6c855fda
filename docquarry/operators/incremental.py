"""Folds and logs that are kept, so that a run works on what is new.

A kept fold is a snapshot in buckets of the key's hash; new requests change only
the buckets they fall into.  A kept log is files of disjoint id ranges with what
retention asks of them; pruning drops files and rewrites the one it cuts.  Both
are numbered versions that name their files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.operators.ledger import transition_fold
from docquarry.sources.objects import delete_prefix
from docquarry.sources.versions import change, ddl, latest

BUCKETS = 64
FOLDED = "state string, accepted long, rejected long, last_order long"


# ---- the fold -----------------------------------------------------------------


def read_fold(
    spark: SparkSession, root: str, key: str, key_type: str = "long", buckets: list[int] | None = None, columns: str = FOLDED
) -> DataFrame:
    """The kept fold, or some of its buckets; ``columns`` are those beside the key."""
    _, told = latest(spark, root)
    folders = [f for b, f in told.get("buckets", {}).items() if buckets is None or int(b) in buckets]
    schema = f"{key} {key_type}, {columns}"
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def keep_fold(
    spark: SparkSession,
    root: str,
    events: DataFrame,
    key: str,
    order: str,
    fold: Callable[[DataFrame, DataFrame], DataFrame],
    columns: str,
    key_type: str = "long",
    buckets: int = BUCKETS,
) -> list[int]:
    """Fold the events newer than the kept fold into it; the buckets that changed.
    ``fold`` makes the new rows of new events and the rows there were.

    Events up to the order it reaches already are passed over, so that a run that
    is repeated changes nothing.  Only the buckets of new events are read and
    written, a task each; the others stay the files they are.  The number of
    buckets is that of the first run: so many that one fits a task."""
    touched: list[int] = []

    def step(number: int, told: dict) -> dict | None:
        count, upto = told.get("count", buckets), told.get("upto")
        fresh = events if upto is None else events.where(F.col(order) > upto)
        bucket = F.pmod(F.xxhash64(F.col(key).cast(key_type)), F.lit(count)).cast("int")
        seen = fresh.groupBy(bucket.alias("b")).agg(F.max(order).alias("o")).collect()  # at most ``count`` rows
        if not seen:
            touched.clear()
            return None
        touched[:] = sorted(r["b"] for r in seen)
        folded = fold(fresh, read_fold(spark, root, key, key_type, touched, columns)).withColumn("_bucket", bucket)
        folder = f"{root}/buckets/{uuid.uuid4().hex}"
        folded.repartition("_bucket").write.partitionBy("_bucket").parquet(folder)
        mapped = told.get("buckets", {}) | {str(b): f"{folder}/_bucket={b}" for b in touched}
        return {"count": count, "upto": max(r["o"] for r in seen), "buckets": mapped}

    change(spark, root, step)
    return list(touched)


def fold_in(spark: SparkSession, root: str, requests: DataFrame, key: str, order: str, target: str, key_type: str = "long", buckets: int = BUCKETS) -> list[int]:
    """``keep_fold`` of transition requests: the columns of ``transition_fold``."""
    fold = lambda fresh, before: transition_fold(fresh, key, order, target, snapshot=before)
    return keep_fold(spark, root, requests, key, order, fold, FOLDED, key_type, buckets)


def _dated(values: dict[str, str]) -> str:
    return ", ".join(f"{name} struct<at:long,value:{kind}>" for name, kind in values.items())


def fold_last_values(spark: SparkSession, root: str, events: DataFrame, key: str, order: str, values: dict[str, str], key_type: str = "long", buckets: int = BUCKETS) -> list[int]:
    """``keep_fold`` of the last value that is not null of each column of ``values`` (name to
    type), kept with the order of its write, since columns are written at
    different times."""

    def fold(fresh: DataFrame, before: DataFrame) -> DataFrame:
        written = [F.when(F.col(v).isNotNull(), F.struct(F.col(order).cast("long").alias("at"), F.col(v).cast(kind).alias("value"))).alias(v) for v, kind in values.items()]
        rows = fresh.select(F.col(key).cast(key_type).alias(key), *written).unionByName(before)
        return rows.groupBy(key).agg(*[F.max(v).alias(v) for v in values])

    return keep_fold(spark, root, events, key, order, fold, _dated(values), key_type, buckets)


def read_last_values(spark: SparkSession, root: str, key: str, values: dict[str, str], key_type: str = "long") -> DataFrame:
    found = read_fold(spark, root, key, key_type, None, _dated(values))
    return found.select(key, *[F.col(f"{v}.value").alias(v) for v in values])


# ---- the log ------------------------------------------------------------------


def _described(spark: SparkSession, folder: str, schema: str, id_: str, at: Column) -> list[dict]:
    """A line for each file of a folder: its ids, its earliest time and its rows."""
    found = spark.read.schema(schema).parquet(folder).groupBy(F.input_file_name().alias("path"))
    told = found.agg(F.min(id_).alias("least"), F.max(id_).alias("most"), F.min(F.unix_micros(at.cast("timestamp"))).alias("earliest"), F.count(F.lit(1)).alias("rows"))
    return sorted((r.asDict() for r in told.collect()), key=lambda f: f["least"])


def append_log(spark: SparkSession, root: str, rows: DataFrame, id_: str, at: Column, files: int = 8) -> None:
    """Append rows whose ids go on from the log's, in files of disjoint id ranges."""
    folder, schema = f"{root}/files/{uuid.uuid4().hex}", ddl(rows)
    rows.repartitionByRange(files, id_).sortWithinPartitions(id_).write.parquet(folder)
    fresh = _described(spark, folder, schema, id_, at)
    change(spark, root, lambda _, told: {"schema": schema, "files": [*told.get("files", []), *fresh]} if fresh else None)


def read_log(spark: SparkSession, root: str, schema: str) -> DataFrame:
    _, told = latest(spark, root)
    paths = [f["path"] for f in told.get("files", [])]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def prune_log(spark: SparkSession, root: str, id_: str, at: Column, cutoff: Column, delete: bool = True) -> dict[str, int]:
    """Drop the rows up to the newest id that is datably before ``cutoff``: how many
    files were ``read``, ``dropped`` and ``rewritten``.

    The files' earliest times say which may hold such an id, so they are read
    from the newest back until one does, mostly one; of disjoint files one at
    most is cut by the mark and written anew.  Rows without any time go by their
    ids alone."""
    did = {"read": 0, "dropped": 0, "rewritten": 0}
    gone: list[str] = []

    def step(number: int, told: dict) -> dict | None:
        did.update(read=0, dropped=0, rewritten=0)
        gone.clear()
        files, schema = told.get("files", []), told.get("schema", "")
        limit = spark.range(1).select(F.unix_micros(cutoff.cast("timestamp"))).first()[0]
        mark = None
        for file in sorted((f for f in files if f["earliest"] is not None and f["earliest"] < limit), key=lambda f: -f["most"]):
            if mark is not None and file["most"] <= mark:
                break
            did["read"] += 1
            found = spark.read.schema(schema).parquet(file["path"]).where(F.unix_micros(at.cast("timestamp")) < limit).agg(F.max(id_)).first()[0]
            mark = found if mark is None else max(mark, found)
        if mark is None:
            return None
        cut = [f for f in files if f["least"] <= mark < f["most"]]
        dropped = [f for f in files if f["most"] <= mark]
        did.update(dropped=len(dropped), rewritten=len(cut))
        gone[:] = [f["path"] for f in [*dropped, *cut]]
        fresh = []
        if cut:
            folder = f"{root}/files/{uuid.uuid4().hex}"
            kept = spark.read.schema(schema).parquet(*[f["path"] for f in cut]).where(F.col(id_) > mark)
            kept.repartitionByRange(len(cut), id_).sortWithinPartitions(id_).write.parquet(folder)
            fresh = _described(spark, folder, schema, id_, at)
        left = [f for f in files if f["least"] > mark]
        return {"schema": schema, "files": sorted([*fresh, *left], key=lambda f: f["least"])} if gone else None

    change(spark, root, step)
    if delete:
        for path in gone:
            delete_prefix(spark, path)
    return dict(did)
