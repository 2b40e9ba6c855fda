"""The message queue as a Spark data source, ``docqueue``: a stream source with its own
offsets and a sink in two phases, for one table of the batches in a folder.

    spark.dataSource.register(DocQueue)
    spark.readStream.format("docqueue").option("path", root).option("table", "messages").schema(...).load()

An offset is the number of the next batch, so a restart goes on where the
checkpoint says and a replay reads the same files.  Tasks of the sink write
files that nobody knows; the commit of a micro-batch puts the manifest that names
them, once for its number, and an abort removes them.  What is written here
``batches.read_batches`` reads, and the other way round.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from docquarry.sources.batches import MANIFESTS

_BATCH = re.compile(r"(\d{20})\.batch\.json$")


class Store:
    """A folder through Arrow's file systems, which the driver's planner and the tasks
    both reach without a session."""

    def __init__(self, root: str) -> None:
        self.system, self.base = pafs.FileSystem.from_uri(root.removeprefix("file:") if "://" not in root else root)

    def names(self, folder: str) -> list[str]:
        found = self.system.get_file_info(pafs.FileSelector(f"{self.base}/{folder}", allow_not_found=True))
        return sorted(f.base_name for f in found if not f.base_name.startswith((".", "_")))

    def read(self, name: str) -> bytes:
        with self.system.open_input_file(f"{self.base}/{name}") as source:
            return source.read()

    def write(self, name: str, data: bytes) -> None:
        place = f"{self.base}/{name}"
        self.system.create_dir(place.rpartition("/")[0], recursive=True)
        with self.system.open_output_stream(place) as out:
            out.write(data)

    def put(self, name: str, data: bytes) -> bool:
        """Whole and once: by a hard link on a mounted folder, else by a look and a
        rename, which suffices as one query commits to a folder."""
        folder, _, base = name.rpartition("/")
        fresh = f"{folder}/.{base}.{uuid.uuid4().hex}"
        if self.system.get_file_info(f"{self.base}/{name}").type != pafs.FileType.NotFound:
            return False
        self.write(fresh, data)
        if isinstance(self.system, pafs.LocalFileSystem):
            try:
                os.link(f"{self.base}/{fresh}", f"{self.base}/{name}")
                return True
            except FileExistsError:
                return False
            finally:
                self.system.delete_file(f"{self.base}/{fresh}")
        self.system.move(f"{self.base}/{fresh}", f"{self.base}/{name}")
        return True

    def delete(self, name: str) -> None:
        if self.system.get_file_info(f"{self.base}/{name}").type == pafs.FileType.File:
            self.system.delete_file(f"{self.base}/{name}")

    def batches(self) -> list[int]:
        return [int(m[1]) for n in self.names(MANIFESTS) if (m := _BATCH.search(n))]

    def files(self, table: str, first: int, end: int) -> list[str]:
        """The files of a table in the batches from ``first`` up to ``end``."""
        out = []
        for number in self.batches():
            if first <= number < end:
                named = json.loads(self.read(f"{MANIFESTS}/{number:020d}.batch.json"))["folders"].get(table, [])
                for place in named if isinstance(named, list) else [f"{named}/{n}" for n in self.names(named) if n.endswith(".parquet")]:
                    out.append(place)
        return out


@dataclass
class File(InputPartition):
    name: str


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


def _read(root: str, schema: StructType, part: File) -> Iterator[pa.RecordBatch]:
    store, wanted = Store(root), to_arrow_schema(schema)
    with store.system.open_input_file(f"{store.base}/{part.name}") as source:
        for batch in pq.ParquetFile(source).iter_batches(batch_size=10_000, columns=wanted.names):
            yield from pa.Table.from_batches([batch]).select(wanted.names).cast(wanted).to_batches()


class Reader(DataSourceReader):
    """All committed batches."""

    def __init__(self, root: str, table: str, schema: StructType) -> None:
        self.root, self.table, self.wanted = root, table, schema

    def partitions(self) -> list[File]:
        return [File(n) for n in Store(self.root).files(self.table, 0, 1 << 62)]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        return _read(self.root, self.wanted, partition)


class StreamReader(DataSourceStreamReader):
    def __init__(self, root: str, table: str, schema: StructType, group: str) -> None:
        self.root, self.table, self.wanted, self.group = root, table, schema, group

    def initialOffset(self) -> dict:
        return {"next": 0}

    def latestOffset(self) -> dict:
        return {"next": max(Store(self.root).batches(), default=-1) + 1}

    def partitions(self, start: dict, end: dict) -> list[File]:
        return [File(n) for n in Store(self.root).files(self.table, start["next"], end["next"])]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        return _read(self.root, self.wanted, partition)

    def commit(self, end: dict) -> None:
        """Tells how far a group has come, for whoever removes what all have read; Spark
        calls this when it plans the batch after."""
        Store(self.root).write(f"groups/{self.group}.json", json.dumps(end).encode())


class StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, root: str, table: str, schema: StructType) -> None:
        self.root, self.table, self.given = root, table, schema

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, name = Store(self.root), f"{self.table}/{uuid.uuid4().hex}.parquet"
        store.system.create_dir(f"{store.base}/{self.table}", recursive=True)
        writer = None
        for batch in iterator:
            if batch.num_rows:
                writer = writer or pq.ParquetWriter(f"{store.base}/{name}", batch.schema, filesystem=store.system)
                writer.write_batch(batch)
        if writer is None:
            return Written([])
        writer.close()
        return Written([name])

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        told = {"number": batchId, "folders": {self.table: files}}
        if not Store(self.root).put(f"{MANIFESTS}/{batchId:020d}.batch.json", json.dumps(told).encode()):
            self.abort(messages, batchId)  # an earlier attempt at this batch counts

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        store = Store(self.root)
        for message in messages:
            for name in message.files if message is not None else []:
                store.delete(name)


class DocQueue(DataSource):
    """Options: ``path``; ``table`` (messages); ``group`` (default), the name under which a
    stream tells how far it is."""

    @classmethod
    def name(cls) -> str:
        return "docqueue"

    def schema(self) -> str:
        return "id long, doc_id string, topic string, payload string, created_at timestamp"

    def _place(self) -> tuple[str, str]:
        return self.options["path"].rstrip("/"), self.options.get("table", "messages")

    def reader(self, schema: StructType) -> Reader:
        return Reader(*self._place(), schema)

    def streamReader(self, schema: StructType) -> StreamReader:
        return StreamReader(*self._place(), schema, self.options.get("group", "default"))

    def streamWriter(self, schema: StructType, overwrite: bool) -> StreamWriter:
        return StreamWriter(*self._place(), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(DocQueue)
