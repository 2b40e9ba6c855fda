"""Objects in a store: listing, bytes, and deterministic writes.

Everything goes through Spark's own readers or Hadoop file systems, so any
store that Spark reaches will do.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _with_empty(spark: SparkSession, prefix: str, pattern: str, listed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``listed`` of a scan, and a row for each empty object, which a scan skips.
    These come from the scan's file index, which the driver holds in any case."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(prefix)
    bare = lambda c: F.regexp_replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "^file:/+", "/")
    known = spark.createDataFrame([(p,) for p in found.inputFiles()], "path string")
    empty = known.join(found.select(bare(F.col("path")).alias("_p")), bare(F.col("path")) == F.col("_p"), "left_anti").select(
        "path", F.lit(None).cast("timestamp").alias("modificationTime"), F.lit(0).cast("long").alias("length"), F.lit(b"").alias("content")
    )
    return listed(found).unionByName(listed(empty))


def list_objects(spark: SparkSession, prefix: str, pattern: str = "*") -> DataFrame:
    """``path``, ``size`` and ``modified`` (null for empty objects) of what is
    below ``prefix``; the bytes are pruned away, so listing reads none."""
    return _with_empty(spark, prefix, pattern, lambda f: f.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")))


def read_objects(spark: SparkSession, prefix: str, pattern: str = "*") -> DataFrame:
    """Also ``content`` and ``content_id``, the identity of the bytes."""
    identity = F.sha2("content", 256).alias("content_id")
    return _with_empty(spark, prefix, pattern, lambda f: f.select("path", F.col("length").alias("size"), "content", identity))


def stream_objects(spark: SparkSession, prefix: str, pattern: str = "*", per_batch: int = 1000) -> DataFrame:
    """New objects as they arrive; the checkpoint remembers which were seen."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    stream = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", per_batch).load(prefix)
    return stream.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("content_id"))


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _file_system(spark, path)
    return bool(system.exists(where))


def delete_prefix(spark: SparkSession, path: str) -> bool:
    system, where = _file_system(spark, path)
    return bool(system.delete(where, True))


def rename(spark: SparkSession, path: str, other: str) -> bool:
    """Move a file or folder; false if something is there already."""
    system, where = _file_system(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(other)
    return not system.exists(target) and bool(system.rename(where, target))


def file_facts(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path, length and time of the files at ``path``, in order; only the listing
    is read."""
    system, where = _file_system(spark, path)
    found = system.listStatus(where)
    return sorted((str(f.getPath()), int(f.getLen()), int(f.getModificationTime())) for f in found)


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Create a bucket or topic folder if it is missing."""
    system, where = _file_system(spark, path)
    system.mkdirs(where)


def put_if_absent(spark: SparkSession, path: str, data: bytes) -> bool:
    """Write a small object unless there is one; false if there was.  It appears
    whole, and of several writers one succeeds: by a hard link on a mounted
    folder, elsewhere by a rename that does not replace, which must be atomic in
    the store."""
    jvm = spark._jvm
    system, target = _file_system(spark, path)
    system.mkdirs(target.getParent())
    fresh = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}")
    with_stream = system.create(fresh, False)
    with_stream.write(data)
    with_stream.close()
    try:
        if system.getScheme() == "file":
            os.link(fresh.toUri().getPath(), target.toUri().getPath())
            return True
        where = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
        keep = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        where.rename(fresh, target, keep)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as fault:
        if "FileAlreadyExists" in fault.java_exception.getClass().getName():
            return False
        raise
    finally:
        system.delete(fresh, False)


def read_small(spark: SparkSession, path: str) -> bytes:
    """The bytes of a small object."""
    system, where = _file_system(spark, path)
    source = system.open(where)
    try:
        return bytes(source.readAllBytes())
    finally:
        source.close()


def names_below(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly below a folder, without hidden files; none if
    there is no such folder."""
    system, where = _file_system(spark, path)
    if not system.exists(where):
        return []
    found = [str(f.getPath().getName()) for f in system.listStatus(where)]
    return sorted(n for n in found if not n.startswith((".", "_")))
