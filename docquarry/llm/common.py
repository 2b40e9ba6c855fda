"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from docquarry.sources.shared import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read by Spark so that any Hadoop path works; texts are dealt
    out where a few row groups would hold up the work on them."""
    found = tuned(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return dealt(found) if name == "documents" else found


def dealt(frame: DataFrame) -> DataFrame:
    """A plain scan, its rows dealt out to all cores if its files have fewer row groups
    than there are cores: a row group is read by one task, whatever its size.  A
    scan of more files than cores, as any large one is, stays as it is, and no
    footer is read."""
    spark = frame.sparkSession
    jvm, cores, paths = spark._jvm, spark.sparkContext.defaultParallelism, frame._jdf.inputFiles()
    if not 0 < len(paths) < cores:
        return frame
    conf, groups = spark._jsc.hadoopConfiguration(), 0
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
        footer = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(where, conf))
        groups += footer.getRowGroups().size()
        footer.close()
    return frame.repartition(cores) if groups < cores else frame


def text_of(column: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """``docs`` with its columns under names of ours, the new name of each, and
    what gives them their own back.  Between the two, columns that an operator
    adds cannot clash with any that the caller has."""
    names = {c: f"_dq_kept{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names, [F.col(n).alias(c) for c, n in names.items()]


def tuned(spark: SparkSession) -> SparkSession:
    """For applications, as the registered queries are: where the session still
    has Spark's own limits, hand Python at most 1000 rows or 16 MB at a time.

    A batch is held several times over between Spark and Python, and texts are
    long.  The operators never change a session; without this they take batches
    of what it sets, 64 MB unless told otherwise."""
    for key, own, wanted in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"),
        ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "16m"),
    ):
        if spark.conf.get(key) == own:
            spark.conf.set(key, wanted)
    return spark


def _release() -> None:
    """Give back what Python keeps between tasks; workers are used again."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def in_arrow(run: Callable, schema: str | StructType) -> Callable[[DataFrame], DataFrame]:
    """``mapInArrow`` for ``DataFrame.transform``.  Spark bounds what it hands over
    by rows and by bytes (see ``tuned``); a single row may be larger.  A worker
    returns its memory at the end of each task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _release()

    return lambda frame: frame.mapInArrow(task, schema)


def written(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``frame`` as Parquet in the shared folder and read it back.

    This cuts the lineage: what follows survives the loss of any executor
    without running what came before again.  All such tables of an application
    lie in one folder, which ``clear_shared`` removes once results are written.
    """
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
