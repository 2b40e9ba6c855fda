"""Objects as bytes: written with the identity that the store would give them, and
read by name."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docquarry.functions import crc32c

#: Types by the ending of a path; anything else is bytes.
ENDINGS = {".pdf": "application/pdf", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png", ".tif": "image/tiff", ".tiff": "image/tiff", ".json": "application/json"}


def content_type(path: Column) -> Column:
    """The type that a path's ending tells, as metadata of an object."""
    ending, told = F.lower(F.regexp_extract(path, r"(\.[A-Za-z0-9]+)$", 1)), F.lit("application/octet-stream")
    for suffix, kind in ENDINGS.items():
        told = F.when(ending == suffix, kind).otherwise(told)
    return told


def _checksums(contents: list[bytes | None]) -> list[int | None]:
    sums = iter(crc32c.of_bytes([c for c in contents if c is not None]).tolist())
    return [None if c is None else next(sums) for c in contents]


def write_blobs(rows: DataFrame, root: str) -> DataFrame:
    """Write each ``content`` to ``root``/``path``; ``path``, ``size``, ``content_type`` and ``object_id``
    of what was read back, an error where that is not what was written.

    An object appears whole, by a rename, and a task that runs again writes the
    same again.  The result is lazy like any frame: objects are written when it is
    evaluated.  A null content writes nothing and has no identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = pafs.FileSystem.from_uri(root.removeprefix("file:") if "://" not in root else root)
        folders = set()
        for batch in batches:
            paths, contents = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for path, content in zip(paths, contents, strict=True):
                if content is None:
                    continue
                place = f"{base}/{path}"
                folder = place.rpartition("/")[0]
                if folder not in folders:
                    system.create_dir(folder, recursive=True)
                    folders.add(folder)
                fresh = f"{place}.{uuid.uuid4().hex}"
                with system.open_output_stream(fresh) as out:
                    out.write(content)
                system.move(fresh, place)
                with system.open_input_file(place) as source:
                    if source.read() != content:
                        raise OSError(f"{path} is not what was written")
            sizes = [None if c is None else len(c) for c in contents]
            told = _checksums(contents)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(told, pa.int64())], ["path", "size", "checksum"])

    written = rows.select("path", "content").mapInArrow(run, "path string, size long, checksum long")
    return written.select("path", "size", content_type(F.col("path")).alias("content_type"), crc32c.identity(F.col("checksum")).alias("object_id"))


def read_blobs(rows: DataFrame, root: str, together: int = 16_000_000) -> DataFrame:
    """``rows`` (``path``, below ``root``) with ``content``, empty objects too, and its CRC-32C as
    ``checksum``; null where there is no such object any more.  Tasks read the objects, some MB at a time; the
    driver lists nothing."""

    def out(paths: list, contents: list) -> pa.RecordBatch:
        columns = [pa.array(paths, pa.string()), pa.array(contents, pa.binary()), pa.array(_checksums(contents), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["path", "content", "checksum"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = pafs.FileSystem.from_uri(root.removeprefix("file:") if "://" not in root else root)
        for batch in batches:
            paths, contents, held = [], [], 0
            for path in batch.column(0).to_pylist():
                content = None
                if path is not None and system.get_file_info(f"{base}/{path}").type == pafs.FileType.File:
                    with system.open_input_file(f"{base}/{path}") as source:
                        content = source.read()
                paths.append(path), contents.append(content)
                held += len(content or b"")
                if held > together:
                    yield out(paths, contents)
                    paths, contents, held = [], [], 0
            if paths:
                yield out(paths, contents)

    return rows.select("path").mapInArrow(run, "path string, content binary, checksum long")


def with_object_ids(objects: DataFrame) -> DataFrame:
    """``objects`` with ``object_id``, the CRC-32C identity of ``content``."""
    return objects.withColumn("object_id", crc32c.identity(crc32c.checksum(F.col("content"))))
