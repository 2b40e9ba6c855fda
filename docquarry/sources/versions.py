"""Numbered versions of a small description, each put once.

Whoever describes version n + 1 has read version n; of several that did, one
succeeds and the others read again.  What the versions describe (rows, files)
is written before, under names of its own.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docquarry.sources.objects import names_below, put_if_absent, read_small


def latest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """The last version and its number; 0 and an empty one where there is none."""
    found = [n for n in names_below(spark, f"{root}/versions") if n.endswith(".json")]
    if not found:
        return 0, {}
    return int(found[-1].partition(".")[0]), json.loads(read_small(spark, f"{root}/versions/{found[-1]}"))


def put_version(spark: SparkSession, root: str, number: int, told: dict) -> bool:
    return put_if_absent(spark, f"{root}/versions/{number:020d}.json", json.dumps(told).encode())


def change(spark: SparkSession, root: str, step: Callable[[int, dict], dict | None], tries: int = 20) -> dict:
    """Put what ``step`` makes of the last version, again from the start if somebody
    was quicker; None from ``step`` leaves all as it is."""
    for _ in range(tries):
        number, told = latest(spark, root)
        wanted = step(number, told)
        if wanted is None or put_version(spark, root, number + 1, wanted):
            return told if wanted is None else wanted
    raise RuntimeError(f"{tries} times somebody else was quicker at {root}")


def ddl(frame: DataFrame) -> str:
    """The columns of a frame as a schema text."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)
