"""Object listing as a DataFrame.

A listing is one row per object: ``key`` (path relative to the listed root),
``path`` (fully qualified), ``size`` and ``last_modified``. Spark's file
sources leave out names that start with ``_`` or ``.``, an object store lists
them, so the store is asked, by tasks: folders are shared out over them
(``store``), and only those that can hold wanted keys are listed. Where tasks
can't reach the file system, Hadoop is asked entry by entry; the driver then
holds ``CHUNK`` entries at most, and a longer listing is written to the
checkpoint folder in pieces and read from there.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType, TimestampType

from gridlake.session import scratch_path
from gridlake.sources import fs, store

CHUNK = 50_000

LISTING_SCHEMA = StructType(
    [
        StructField("key", StringType()),
        StructField("path", StringType()),
        StructField("size", LongType()),
        StructField("last_modified", TimestampType()),
        StructField("is_dir", BooleanType()),
    ]
)


def _root(spark: SparkSession, root: str) -> str:
    q = fs.qualify(spark, root)
    return q if q.endswith("/") else q + "/"


def _entries(spark: SparkSession, root: str, prefix: str, recursive: bool) -> Iterator[tuple]:
    """The objects below the folder of the prefix; a sub-folder is one entry unless recursive."""
    base = _root(spark, root)
    folder = prefix.rpartition("/")[0]
    for e in fs.walk(spark, base + folder, recursive):
        path = e.path if e.path.startswith(base) else fs.qualify(spark, e.path)
        key = path[len(base):] + ("/" if e.is_dir else "")
        if key.startswith(prefix):
            size, time = (None, None) if e.is_dir else (e.length, datetime.fromtimestamp(e.modification_time / 1000, timezone.utc))
            yield key, path + ("/" if e.is_dir else ""), size, time, e.is_dir


def list_objects(
    spark: SparkSession,
    root: str,
    prefix: str | None = None,
    recursive: bool = True,
    start_after: str | None = None,
) -> DataFrame:
    """Objects under ``root`` whose key starts with ``prefix``, hidden ones included.

    ``recursive=False`` returns the entries directly under the prefix: files
    at that level, plus one row per sub-folder (its key ends with ``/`` and
    ``is_dir`` is true), as an object store's delimiter listing does.
    ``start_after`` keeps keys that sort after it.
    """
    base = _root(spark, root)
    if store.reachable(base):
        return store.listing(spark, base, prefix=prefix or "", start_after=start_after or "", recursive=str(recursive).lower())
    found = _entries(spark, root, prefix or "", recursive)
    some = list(islice(found, CHUNK))
    rows = spark.createDataFrame(some, LISTING_SCHEMA)
    if len(some) == CHUNK:
        path = scratch_path(spark, f"listing-{uuid.uuid4().hex}")
        while some:
            spark.createDataFrame(some, LISTING_SCHEMA).write.mode("append").parquet(path)
            some = list(islice(found, CHUNK))
        rows = spark.read.schema(LISTING_SCHEMA).parquet(path)
    return rows.where(F.col("key") > F.lit(start_after)) if start_after else rows


def prefix_exists(spark: SparkSession, root: str, prefix: str = "") -> bool:
    """True when at least one object or folder exists under ``root/prefix``.

    The folder of the prefix is listed up to the first match.
    """
    return next(_entries(spark, root, prefix, recursive=False), None) is not None
