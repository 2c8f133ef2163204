"""Folders of Arrow IPC files as a Spark data source.

    df.write.format("arrow_files").mode("overwrite").save("s3a://lake/t")
    spark.read.format("arrow_files").load("s3a://lake/t")

Writing has two phases, so that a folder never shows part of a write: every task
attempt writes a file of its own below ``_temporary/<write>/``, and the driver
moves the files of the attempts that Spark committed, then removes the rest, or
removes all of them if the job fails. An overwrite takes the old files away only
then. A file is read as one partition, batch by batch.

Like listings, files are reached by tasks through ``pyarrow``, so the folder must
lie in a store of ``store.SCHEMES``.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from gridlake.sources import store

ENDING = ".arrow"
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _place(options: dict[str, str]):
    """The file system and the folder in it."""
    from pyarrow import fs

    path = options["path"].rstrip("/")
    if "://" not in path and not path.startswith("file:"):
        path = "file:" + path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.partition(":")[2].lstrip("/")
    if not store.reachable(path):
        raise ValueError(f"tasks can't reach {path!r}; known schemes: {store.SCHEMES}")
    found = store.opened(path, options)
    return found.fs, found.top.rstrip("/")


def _files(options: dict[str, str]) -> list[str]:
    """The data files of the folder, by name."""
    from pyarrow import fs

    system, folder = _place(options)
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.path for f in found if f.type == fs.FileType.File and f.base_name.endswith(ENDING) and f.base_name[0] not in "._")


@dataclass(frozen=True)
class File(InputPartition):
    path: str


@dataclass(frozen=True)
class Written(WriterCommitMessage):
    name: str | None


class FolderReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.options, self.names = options, schema.names

    def partitions(self) -> list[File]:
        return [File(f) for f in _files(self.options)]

    def read(self, partition: File | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an empty folder
            return
        system, _ = _place(self.options)
        with system.open_input_file(partition.path) as f:
            file = pa.ipc.open_file(f)
            for i in range(file.num_record_batches):
                yield file.get_batch(i).select(self.names)


class FolderWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.options, self.overwrite, self.job = options, overwrite, uuid.uuid4().hex
        self.schema = to_arrow_schema(schema)
        system, folder = _place(options)
        system.create_dir(self._temporary(folder), recursive=True)

    def _temporary(self, folder: str) -> str:
        return f"{folder}/_temporary/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = _place(self.options)
        name, out = f"part-{uuid.uuid4().hex}{ENDING}", None
        try:
            for batch in iterator:
                if out is None:  # no folder is made: a task that outlives the abort must not bring it back
                    sink = system.open_output_stream(f"{self._temporary(folder)}/{name}")
                    schema = self.schema if batch.schema.equals(self.schema) else batch.schema
                    out = pa.ipc.new_file(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))
                out.write_batch(batch)
        finally:
            if out is not None:
                out.close()
                sink.close()
        return Written(name if out is not None else None)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = _place(self.options)
        system.create_dir(folder, recursive=True)
        old = _files(self.options) if self.overwrite else []
        names = [m.name for m in messages if m is not None and m.name]
        if not names and (self.overwrite or not _files(self.options)):  # the schema stays known
            names = [f"part-{uuid.uuid4().hex}{ENDING}"]
            with system.open_output_stream(f"{self._temporary(folder)}/{names[0]}") as sink, pa.ipc.new_file(sink, self.schema):
                pass
        for name in names:
            system.move(f"{self._temporary(folder)}/{name}", f"{folder}/{name}")
        for f in old:
            system.delete_file(f)
        self._clear(system, folder)
        with system.open_output_stream(f"{folder}/_SUCCESS"):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*_place(self.options))

    def _clear(self, system, folder: str) -> None:
        from pyarrow import fs

        if system.get_file_info(self._temporary(folder)).type == fs.FileType.Directory:
            system.delete_dir(self._temporary(folder))
        left = f"{folder}/_temporary"
        if system.get_file_info(left).type == fs.FileType.Directory and not system.get_file_info(fs.FileSelector(left)):
            system.delete_dir(left)


class ArrowFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "arrow_files"

    def schema(self) -> StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        found = _files(dict(self.options))
        if not found:
            raise ValueError(f"no {ENDING} files in {self.options['path']!r}")
        with _place(dict(self.options))[0].open_input_file(found[0]) as f:
            return from_arrow_schema(pa.ipc.open_file(f).schema, prefer_timestamp_ntz=True)

    def reader(self, schema: StructType) -> FolderReader:
        return FolderReader(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> FolderWriter:
        return FolderWriter(dict(self.options), schema, overwrite)


def register(spark: SparkSession) -> None:
    """Make the source known. Sources are looked up in the thread's active session, which another
    thread than the one that made the session hasn't got before it makes a frame."""
    spark.createDataFrame([], "x int")
    spark.dataSource.register(ArrowFiles)
