"""Token counts from flat, unindexed token files by a separator scan.

A token file is nothing but identifiers, two bytes each (four for a large
vocabulary), with an end-of-document identifier after each document.  The scan
cuts files into blocks, finds the separators of each block with one vectorised
comparison, and stitches documents that cross blocks with prefix sums over the
block summaries.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docquarry.llm.common import in_arrow, table, text_of, written
from docquarry.sources.shared import shared_dir

#: A tiktoken rank file, its splitting pattern, and the identifier after it.
RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEPARATOR = 50256
BLOCK_TOKENS = 1 << 20


def load_encoding(path: str = RANKS) -> tiktoken.Encoding:
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _file_system(directory: str) -> tuple[pafs.FileSystem, str]:
    """By the scheme of the shared folder; a plain path is a mounted folder."""
    if "://" not in directory and directory.startswith("file:"):
        directory = directory[len("file:") :]
    return pafs.FileSystem.from_uri(directory)


def write_token_files(docs: DataFrame, directory: str, ranks: str = RANKS, separator: int = SEPARATOR) -> DataFrame:
    """Tokenise ``docs`` into flat files in ``directory``, a file per task.

    Returns ``file``, ``nth`` and ``doc_id``: which document is which in its
    file, but not where.  A null text counts as empty and leaves a separator
    only.  A task that is run again writes a new file; only files named in the
    result belong to it.
    """
    wide = separator >= 1 << 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, out, name, nth = load_encoding(ranks), None, "", 0
        kind = np.dtype("<u4" if wide else "<u2")
        end = np.array([separator], kind)
        system, root = _file_system(directory)
        for batch in batches:
            if out is None:
                name = f"tokens-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.bin"
                system.create_dir(root, recursive=True)
                out = system.open_output_stream(f"{root}/{name}")
            for text in batch.column(1):
                out.write(np.array(encoding.encode_ordinary(text.as_py()), kind).tobytes())
                out.write(end.tobytes())
            count = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * count), pa.array(np.arange(nth, nth + count, dtype=np.int64)), batch.column(0)], ["file", "nth", "doc_id"]
            )
            nth += count
        if out is not None:
            out.close()

    return written(docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).transform(in_arrow(run, "file string, nth long, doc_id long")), "token-docs")


def scan_token_files(
    spark: SparkSession, directory: str, separator: int = SEPARATOR, block_tokens: int = BLOCK_TOKENS, width: int = 2
) -> DataFrame:
    """``file``, ``nth``, ``first`` (token offset) and ``n_tokens`` of every
    document in the token files of ``directory``.

    Separators are not counted.  Neighbouring separators give documents without
    tokens; tokens after the last separator are a document; an empty file has
    none.  A task reads one block; the prefix sums see a row per block.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(directory).select("path", "length")
    size = block_tokens * width
    blocks = (
        listed.where("length > 0")
        .select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long"))).alias("at"))
        .repartition("path", "at")
    )
    kind = "<u4" if width == 4 else "<u2"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _file_system(directory)
        for batch in batches:
            for path, length, at in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                name = path.rpartition("/")[2]
                with system.open_input_file(f"{root}/{name}") as source:
                    found = np.frombuffer(source.read_at(min(size, length - at), at), kind)
                ends = np.flatnonzero(found == separator).astype(np.int64) + at // width
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name]),
                        pa.array([at], pa.int64()),
                        pa.array([at + size >= length]),
                        pa.array([length // width], pa.int64()),
                        pa.array([ends], pa.list_(pa.int64())),
                    ],
                    ["file", "at", "final", "tokens", "ends"],
                )

    summaries = written(blocks.transform(in_arrow(run, "file string, at long, final boolean, tokens long, ends array<long>")), "token-blocks")
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    stitched = (
        summaries.withColumn("n", F.size("ends"))
        .withColumn("docs_before", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long"))
        .withColumn("open_from", F.coalesce(F.max(F.array_max("ends") + 1).over(before), F.lit(0)).cast("long"))
        # what follows the last separator of a file ends where the file does
        .withColumn("last_end", F.coalesce(F.array_max("ends") + 1, F.col("open_from")))
        .withColumn("ends", F.when(F.col("final") & (F.col("last_end") < F.col("tokens")), F.concat("ends", F.array("tokens"))).otherwise(F.col("ends")))
    )
    return stitched.select("file", "docs_before", "open_from", "ends", F.posexplode("ends").alias("k", "end")).select(
        "file",
        (F.col("docs_before") + F.col("k")).alias("nth"),
        F.when(F.col("k") == 0, F.col("open_from")).otherwise(F.get("ends", F.col("k") - 1) + 1).alias("first"),
        F.col("end"),
    ).select("file", "nth", "first", (F.col("end") - F.col("first")).alias("n_tokens"))


def count_tokens(docs: DataFrame, ranks: str = RANKS, separator: int = SEPARATOR) -> DataFrame:
    """``doc_id`` and ``n_tokens`` per row, by way of token files in the shared
    folder.  Null texts have 0 tokens; repeated rows are counted each; other
    columns are not read.  A very long text is tokenised whole, in one piece."""
    directory = f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    manifest = write_token_files(docs, directory, ranks, separator)
    if manifest.isEmpty():
        return manifest.select("doc_id", F.lit(0).cast("long").alias("n_tokens"))
    counts = scan_token_files(docs.sparkSession, directory, separator, width=4 if separator >= 1 << 16 else 2)
    return manifest.join(counts, ["file", "nth"]).select("doc_id", "n_tokens")


def op7_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``count_tokens`` of ``documents``, a row per row; null and empty texts have no tokens."""
    return count_tokens(table(spark, sf_dir, "documents"))
