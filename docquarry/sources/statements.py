"""Named SQL from packaged files, run with parameters only."""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"^--\s*name:\s*(\w+)\s*$", re.M)


class UnknownStatement(ImportError):
    pass


def parse(text: str) -> dict[str, str]:
    """Blocks begin with ``-- name: x``; a name may be given once."""
    parts = _NAME.split(text)
    names, bodies = parts[1::2], parts[2::2]
    if len(set(names)) != len(names):
        raise ValueError("a statement is named twice")
    found = {}
    for name, body in zip(names, bodies, strict=True):
        lines = [x for x in body.splitlines() if x.strip() and not x.lstrip().startswith("--")]
        found[name] = "\n".join(lines).rstrip().removesuffix(";")
        if not found[name]:
            raise ValueError(f"statement {name} is empty")
    return found


def load(file: str) -> dict[str, str]:
    return parse(resources.files("docquarry.sql").joinpath(f"{file}.sql").read_text())


def run(spark: SparkSession, file: str, name: str, tables: dict[str, DataFrame], **args) -> DataFrame:
    """Run a statement over ``tables``; values are bound, never written into it."""
    found = load(file)
    if name not in found:
        raise UnknownStatement(f"{file}.sql has no statement {name}")
    return spark.sql(found[name], args=args, **tables)
