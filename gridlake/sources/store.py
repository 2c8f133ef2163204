"""Objects of a store as seen from tasks: a Spark data source of listings, and the heads of files.

Listing and reading the first line of a file are metadata work that Spark's
own sources do on the driver, or by reading whole files. Here both are tasks'
work. ``register`` makes the data source ``objects`` known to a session:

    spark.read.format("objects").option("root", "s3a://lake/").load()

A partition is a folder: alone, or with all below it. The driver walks down from
the root only until there are enough folders to share out, looks at no more than
``PLAN_ENTRIES`` entries of a folder for that, and keeps none but the folders. Tasks
stream entries to Spark in batches. ``prefix`` and ``start_after`` (options, or
filters on ``key`` where the session has ``spark.sql.python.filterPushdown.enabled``)
leave out folders that can't hold such keys before they are listed.

Tasks reach local and object stores by ``pyarrow``. For other file systems
(``reachable`` is false) the callers ask Hadoop on the driver.

The functions are pickled by value, so workers need not have this package.
"""

from __future__ import annotations

import os
import sys
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, InputPartition, StringStartsWith

SCHEMA = "key string, path string, size long, last_modified timestamp, is_dir boolean"
PARTITIONS = 64  # folders to share out
PLAN_ENTRIES = 10_000
BATCH = 10_000
HEAD_BYTES = 1 << 16
S3_SCHEMES = ("s3a", "s3")
SCHEMES = ("file", "gs", *S3_SCHEMES)

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def reachable(path: str) -> bool:
    """Whether tasks can open a fully qualified path themselves."""
    return path.partition(":")[0] in SCHEMES


def settings(spark: SparkSession) -> dict[str, str]:
    """What a task needs of the session's s3a settings, as reader options."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = {name: conf.get(f"fs.s3a.{name}") for name in ("endpoint", "access.key", "secret.key", "connection.ssl.enabled")}
    return {k: v for k, v in found.items() if v}


# ---- stores --------------------------------------------------------------------------------


class _Local:
    """Folders of a mounted file system."""

    def __init__(self, root: str):
        self.top = "/" + root.partition(":")[2].lstrip("/")

    def entries(self, folder: str) -> Iterator[tuple[str, bool, int, int]]:
        """(name, is a folder, bytes, modification in milliseconds) of each entry, as they come."""
        try:
            found = os.scandir(self.top + folder)
        except (FileNotFoundError, NotADirectoryError):
            return
        with found:
            for e in found:
                if e.name.startswith(".") and e.name.endswith(".crc"):
                    continue  # Hadoop's checksum of the file beside it
                try:
                    s = e.stat()
                except FileNotFoundError:  # gone since, or a link to nothing
                    continue
                yield e.name, e.is_dir(), s.st_size, s.st_mtime_ns // 1_000_000

    def open(self, key: str):
        return open(self.top + key, "rb", buffering=0)


class _Arrow:
    """Folders of an object store that pyarrow knows."""

    def __init__(self, root: str, options: dict[str, str]):
        from pyarrow import fs

        scheme, _, rest = root.partition("://")
        if scheme in S3_SCHEMES:
            endpoint = options.get("endpoint", "")
            secure = options.get("connection.ssl.enabled", "true").lower() != "false" and not endpoint.startswith("http://")
            self.fs = fs.S3FileSystem(
                access_key=options.get("access.key"), secret_key=options.get("secret.key"),
                endpoint_override=endpoint.rpartition("://")[2] or None, scheme="https" if secure else "http",
            )
            self.top = rest
        else:
            self.fs, self.top = fs.FileSystem.from_uri(root)
            self.top += "/" * (not self.top.endswith("/"))

    def entries(self, folder: str) -> Iterator[tuple[str, bool, int, int]]:
        from pyarrow import fs

        for e in self.fs.get_file_info(fs.FileSelector((self.top + folder).rstrip("/"), allow_not_found=True)):
            is_dir = e.type == fs.FileType.Directory
            yield e.base_name, is_dir, e.size or 0, (e.mtime_ns or 0) // 1_000_000

    def open(self, key: str):
        return self.fs.open_input_stream(self.top + key, compression=None)


def opened(root: str, options: dict[str, str]):
    return _Local(root) if root.startswith("file:") else _Arrow(root, options)


# ---- listings as a data source -------------------------------------------------------------


@dataclass(frozen=True)
class Folder(InputPartition):
    """A folder to list: its own objects, or all below it."""

    key: str
    deep: bool


class ListingReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)
        self.root = options["root"] if options["root"].endswith("/") else options["root"] + "/"
        self.prefix, self.after = options.get("prefix", ""), options.get("start_after", "")
        self.recursive = options.get("recursive", "true").lower() != "false"

    def may_hold(self, folder: str) -> bool:
        """Whether keys that start with ``folder`` can be wanted."""
        near = folder.startswith(self.prefix) or self.prefix.startswith(folder)
        return near and (folder > self.after or self.after.startswith(folder))

    def partitions(self) -> list[Folder]:
        top = self.prefix.rpartition("/")[0] + "/" if "/" in self.prefix else ""
        if not self.recursive:
            return [Folder(top, False)]
        store, todo, own, whole = opened(self.root, self.options), deque([top]), [], []
        while todo and len(todo) + len(own) + len(whole) < int(self.options.get("partitions", PARTITIONS)):
            folder, subs = todo.popleft(), []
            for n, (name, is_dir, _, _) in enumerate(store.entries(folder)):
                if n >= PLAN_ENTRIES:
                    whole.append(folder)
                    break
                if is_dir and self.may_hold(f"{folder}{name}/"):
                    subs.append(f"{folder}{name}/")
            else:
                own.append(folder)
                todo += subs
        return [Folder(f, False) for f in own] + [Folder(f, True) for f in (*whole, *todo)]

    def _found(self, part: Folder) -> Iterator[tuple]:
        store, todo = opened(self.root, self.options), [part.key]
        while todo:
            folder = todo.pop()
            for name, is_dir, size, ms in store.entries(folder):
                key = f"{folder}{name}" + "/" * is_dir
                if is_dir and self.recursive:
                    if part.deep and self.may_hold(key):
                        todo.append(key)
                elif key.startswith(self.prefix) and key > self.after:
                    yield key, self.root + key, None if is_dir else size, None if is_dir else ms * 1000, is_dir

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.string()), ("path", pa.string()), ("size", pa.int64()), ("last_modified", pa.timestamp("us", "UTC")), ("is_dir", pa.bool_())])
        rows = []
        for row in self._found(partition):
            rows.append(row)
            if len(rows) == BATCH:
                yield pa.record_batch(list(zip(*rows, strict=True)), schema=schema)
                rows = []
        if rows:
            yield pa.record_batch(list(zip(*rows, strict=True)), schema=schema)


class PushedListingReader(ListingReader):
    """A reader that takes bounds on ``key`` out of a query's filters."""

    def pushFilters(self, filters):
        for f in filters:
            if getattr(f, "attribute", None) == ("key",) and isinstance(getattr(f, "value", None), str):
                if isinstance(f, (StringStartsWith, EqualTo)) and f.value.startswith(self.prefix):
                    self.prefix = f.value
                elif isinstance(f, GreaterThan):
                    self.after = max(self.after, f.value)
            yield f  # Spark filters the rows all the same


class ObjectListing(DataSource):
    """One row per object below ``root``: key, path, size, last_modified, is_dir."""

    @classmethod
    def name(cls) -> str:
        return "objects"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ListingReader:
        return (PushedListingReader if self.options.get("pushdown") == "true" else ListingReader)(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the source known. Sources are looked up in the thread's active session, which another
    thread than the one that made the session hasn't got before it makes a frame."""
    spark.createDataFrame([], "x int")
    spark.dataSource.register(ObjectListing)


def listing(spark: SparkSession, root: str, **options: str) -> DataFrame:
    """The objects below a fully qualified root; options as above."""
    register(spark)
    push = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format("objects").options(root=root, pushdown=push, **settings(spark), **options).load()


# ---- heads of files ------------------------------------------------------------------------


def first_line(source, packed: bool, most: int = HEAD_BYTES) -> tuple[str, int]:
    """The first line of an open file, and how many bytes were read for it. ``most`` are read at a time."""
    out, n = b"", 0
    unpack = zlib.decompressobj(31) if packed else None
    while b"\n" not in out and b"\r" not in out:
        some = source.read(most)
        if not some:
            break
        n += len(some)
        out += unpack.decompress(some, 4 * most) if unpack else some
    return out.replace(b"\r", b"\n").partition(b"\n")[0].decode("utf-8", "replace").removeprefix("\ufeff"), n


def heads(files: DataFrame, options: dict[str, str]) -> DataFrame:
    """path, header, bytes: the first line of each file of a frame with a column ``path``; no more than its head is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores: dict = {}
        for batch in batches:
            paths, lines, sizes = batch.column("path").to_pylist(), [], []
            for p in paths:
                scheme, _, rest = p.partition(":")
                bucket = "" if scheme == "file" else rest.lstrip("/").partition("/")[0]
                root = "file:/" if scheme == "file" else f"{scheme}://{bucket}/"
                if root not in stores:
                    stores[root] = opened(root, options)
                key = rest.lstrip("/") if scheme == "file" else rest.lstrip("/").partition("/")[2]
                with stores[root].open(key) as f:
                    line, n = first_line(f, p.endswith(".gz"))
                lines.append(line)
                sizes.append(n)
            yield pa.record_batch([pa.array(paths, pa.string()), pa.array(lines, pa.string()), pa.array(sizes, pa.int64())], ["path", "header", "bytes"])

    return files.select("path").mapInArrow(run, "path string, header string, bytes long")
