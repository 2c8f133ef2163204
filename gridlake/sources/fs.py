"""Metadata operations on the cluster filesystem (HDFS, S3A, local).

Data always moves through Spark readers and writers; these helpers only
answer metadata questions (does a path exist, what is under it) and remove
folders, through the Hadoop ``FileSystem`` of the running session so that
the same code works on any scheme Spark is configured for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    is_dir: bool
    length: int
    modification_time: int


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p)) and bool(fs.getFileStatus(p).isDirectory())


def _entry(status) -> Entry:
    """One call instead of four: a status names its fields, in this order, in its text."""
    m = _STATUS.match(str(status.toString()))
    if m:
        return Entry(m["path"], m["dir"] == "true", int(m["length"] or 0), int(m["time"]))
    return Entry(str(status.getPath().toString()), bool(status.isDirectory()), int(status.getLen()), int(status.getModificationTime()))


_STATUS = re.compile(
    r"\w+\{path=(?P<path>.*); isDirectory=(?P<dir>true|false); (?:length=(?P<length>\d+); replication=\d+; blocksize=\d+; )?"
    r"modification_time=(?P<time>\d+); (?!.*; isDirectory=)",
    re.S,
)


def walk(spark: SparkSession, path: str, recursive: bool = True) -> Iterator[Entry]:
    """Everything below a folder, hidden names included, one entry after the
    other as the filesystem lists it; nothing if the folder is missing."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return
    found = fs.listFiles(p, True) if recursive else fs.listStatusIterator(p)
    while found.hasNext():
        yield _entry(found.next())


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, recursive))


def qualify(spark: SparkSession, path: str) -> str:
    """Fully-qualified form of ``path`` (``/x`` -> ``file:/x`` locally)."""
    fs, p = _fs(spark, path)
    return str(fs.makeQualified(p).toString())
