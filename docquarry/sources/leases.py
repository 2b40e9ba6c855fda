"""Sweeps side by side: leases on hash ranges, and claims that are made once.

A range belongs to one sweeper until its lease runs out; the next lease is put
under the next number, which only one can do.  A lease saves work, it is not what
keeps claims apart: a sweeper that was held up may still believe in an old one.
Claims of a range are themselves numbered versions, so one that was made without
knowing the last claim of its range is refused.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docquarry.sources.objects import names_below
from docquarry.sources.versions import ddl, latest, put_version


def range_of(key: str, ranges: int):
    return F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int")


def _lease(root: str, part: int) -> str:
    return f"{root}/leases/range={part:05d}"


def take_ranges(spark: SparkSession, root: str, holder: str, ranges: int, now_ms: int, ttl_ms: int, most: int | None = None) -> list[int]:
    """The ranges that ``holder`` now has, its own ones renewed, at most ``most``; free
    are those without a lease, with one that ran out, or with one given back."""
    held = []
    for part in range(ranges):
        if most is not None and len(held) >= most:
            break
        number, told = latest(spark, _lease(root, part))
        if (not told or told["holder"] == holder or told["until"] <= now_ms) and put_version(
            spark, _lease(root, part), number + 1, {"holder": holder, "until": now_ms + ttl_ms}
        ):
            held.append(part)
    return held


def give_back(spark: SparkSession, root: str, holder: str, ranges: int) -> None:
    for part in range(ranges):
        number, told = latest(spark, _lease(root, part))
        if told and told["holder"] == holder:
            put_version(spark, _lease(root, part), number + 1, {"holder": "", "until": 0})


def _claims(root: str, part: int) -> str:
    return f"{root}/claims/range={part:05d}"


def claimed(spark: SparkSession, root: str, schema: str, parts: list[int]) -> tuple[DataFrame, dict[int, tuple[int, dict]]]:
    """All rows claimed in these ranges, and the version of each range they are of."""
    known = {part: latest(spark, _claims(root, part)) for part in parts}
    folders = [f for _, told in known.values() for f in told.get("folders", [])]
    rows = spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    return rows, known


def claim(spark: SparkSession, root: str, candidates: DataFrame, key: str, parts: list[int], ranges: int, holder: str) -> tuple[DataFrame, list[int]]:
    """Claim the rows of ``candidates`` in ``parts`` that nobody has claimed (by ``key``);
    they, and the ranges in which the claim came too late and holds nothing.

    One job finds and writes the rows of all ranges; each range then has its own
    version, which either counts whole or not at all."""
    schema = ddl(candidates)
    taken, known = claimed(spark, root, schema, parts)
    marked = candidates.withColumn("lease_range", range_of(key, ranges)).where(F.col("lease_range").isin(parts))
    fresh = marked.join(taken.select(key).distinct(), key, "left_anti").select(*candidates.columns, "lease_range")
    folder = f"{root}/rows/{uuid.uuid4().hex}"
    fresh.write.partitionBy("lease_range").parquet(folder)
    filled = [int(n.partition("=")[2]) for n in names_below(spark, folder)]
    won, late = [], []
    for part in filled:  # at most ``ranges``
        number, told = known[part]
        mine = f"{folder}/lease_range={part}"
        if put_version(spark, _claims(root, part), number + 1, {"holder": holder, "folders": [*told.get("folders", []), mine]}):
            won.append(mine)
        else:
            late.append(part)
    return spark.read.schema(schema).parquet(*won) if won else spark.createDataFrame([], schema), late

