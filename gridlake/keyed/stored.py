"""Upserts and deletes into rows that are stored by partition.

The rows lie as Parquet in folders of the partition columns, as
``write_partitioned`` writes them. A change reads the stored keys to find the
partitions that hold the batch's keys, rewrites these and the ones the batch's
rows go to, and leaves the files of all others alone. A key whose new row
belongs to another partition leaves its old one.

The new content of the touched partitions is written to the scratch folder
first: a change that fails before its last step has changed nothing, and Spark's
dynamic partition overwrite, which commits the last step, can be repeated from there. One
writer at a time; this is no table format.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.keyed import ops
from gridlake.session import scratch_path
from gridlake.sources import files, fs


def _partitions(rows: DataFrame, partition_by: Sequence[str]) -> list[tuple]:
    """The distinct partitions of some rows: as many as there are folders at most."""
    return [tuple(r) for r in rows.select(*partition_by).distinct().collect()]


def _within(partition_by: Sequence[str], values: list[tuple]) -> Column:
    """A filter on partition columns alone, so that no other folder is read."""
    if len(partition_by) == 1:
        known = [v for (v,) in values if v is not None]
        here = F.col(partition_by[0]).isin(known) if known else F.lit(False)
        return here | F.col(partition_by[0]).isNull() if len(known) < len(values) else here
    same = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(partition_by, row, strict=True)]) for row in values]
    return reduce(Column.__or__, same, F.lit(False))


def touched_partitions(stored: DataFrame, keys: DataFrame, key: Sequence[str], partition_by: Sequence[str]) -> list[tuple]:
    """The partitions that hold a row of one of the keys; reads key and partition columns only."""
    held = stored.select(*key, *partition_by).join(keys.select(*key).distinct(), list(key), "left_semi")
    return _partitions(held, partition_by)


def _rewrite(spark: SparkSession, path: str, rows: DataFrame, touched: list[tuple], partition_by: Sequence[str], **write) -> None:
    """Replace the touched partitions by ``rows``; one without rows goes."""
    kept = scratch_path(spark, f"rewrite-{uuid.uuid4().hex}")
    rows.write.parquet(kept)
    new = spark.read.schema(rows.schema).parquet(kept)
    left = set(_partitions(new, partition_by))
    if left:
        files.write_partitioned(new, path, list(partition_by), mode="overwrite", dynamic=True, **write)
    for gone in set(touched) - left:
        name = lambda v: "__HIVE_DEFAULT_PARTITION__" if v is None else str(v)
        fs.delete(spark, path.rstrip("/") + "/" + "/".join(f"{c}={name(v)}" for c, v in zip(partition_by, gone, strict=True)))
    fs.delete(spark, kept)


def upsert_stored(
    spark: SparkSession, path: str, batch: DataFrame, key: Sequence[str] | str, ordering, tiebreak=(),
    partition_by: Sequence[str] = ("year",), mode: str = "event", **write,
) -> int:
    """``ops.upsert`` of a batch into stored rows; the number of partitions that were rewritten.

    The batch has the stored columns. ``write`` goes to ``write_partitioned``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    stored = spark.read.parquet(path)
    batch = ops.create(batch, keys, ordering, tiebreak).select(stored.columns)
    touched = sorted(set(touched_partitions(stored, batch, keys, partition_by)) | set(_partitions(batch, partition_by)), key=repr)
    rows = stored.where(_within(partition_by, touched))
    _rewrite(spark, path, ops.upsert(rows, batch, keys, ordering, tiebreak, mode), touched, partition_by, **write)
    return len(touched)


def delete_stored(spark: SparkSession, path: str, gone: DataFrame, key: Sequence[str] | str, partition_by: Sequence[str] = ("year",), **write) -> int:
    """``ops.delete`` of keys from stored rows; the number of partitions that were rewritten."""
    keys = [key] if isinstance(key, str) else list(key)
    stored = spark.read.parquet(path)
    touched = touched_partitions(stored, gone, keys, partition_by)
    if touched:
        _rewrite(spark, path, ops.delete(stored.where(_within(partition_by, touched)), gone, keys), touched, partition_by, **write)
    return len(touched)
