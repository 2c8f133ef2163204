"""The keyed operations as plain functions of frames.

Rows go in, rows come out: ``create``, ``insert``, ``upsert`` and ``delete``
take the table's rows and a batch and return the table's new rows, lazily. How
and where they are stored is Spark's business (``write_partitioned``,
``saveAsTable``); no log, timeline or index is kept here. A history of commits
is resolved by ``merge.resolve``.

Rows with a NULL key are refused: ``create``, ``insert`` and ``upsert`` fail
the job that meets one, instead of losing it at a later read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.keyed import merge
from gridlake.operators.dedupe import latest_per_key, order_key

READS = {"snap": "snapshot", "incr": "incremental", "time": "as_of"}  # the reference's names


def _names(x: Sequence[str] | str) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def refuse_null_keys(batch: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """``batch``, failing at run time on a row whose key is NULL."""
    for k in _names(key):
        checked = F.when(F.col(k).isNull(), F.raise_error(F.lit(f"the key {k} is NULL"))).otherwise(F.col(k))
        batch = batch.withColumn(k, checked)
    return batch


def create(batch: DataFrame, key, ordering, tiebreak=()) -> DataFrame:
    """The table is the batch, one row per key (the latest)."""
    return latest_per_key(refuse_null_keys(batch, key), _names(key), _names(ordering), _names(tiebreak))


def insert(rows: DataFrame, batch: DataFrame, key) -> DataFrame:
    """Bulk insert; duplicates are kept. New columns of the batch are NULL in older rows."""
    return rows.unionByName(refuse_null_keys(batch, key), allowMissingColumns=True)


def upsert(rows: DataFrame, batch: DataFrame, key, ordering, tiebreak=(), mode: str = "event") -> DataFrame:
    """Per key the batch's latest row replaces the stored rows, in mode ``event`` only
    if its ordering value is not below theirs (NULL lowest)."""
    if mode not in merge.MODES:
        raise ValueError(f"mode must be one of {merge.MODES}, got {mode!r}")
    keys = _names(key)
    best = create(batch, keys, ordering, tiebreak)
    if mode == "event":
        rank = order_key(_names(ordering))
        stored = rows.groupBy(*keys).agg(F.max(rank).alias("_stored"))
        best = best.join(stored, keys, "left").where(F.col("_stored").isNull() | (rank >= F.col("_stored"))).drop("_stored")
    kept = rows.join(best.select(*keys), keys, "left_anti")
    return kept.unionByName(best, allowMissingColumns=True)


def delete(rows: DataFrame, keys: DataFrame, key) -> DataFrame:
    """T4: drop the rows of the given keys; unknown keys change nothing."""
    return rows.join(keys.select(*_names(key)).distinct(), _names(key), "left_anti")


def lookup(rows: DataFrame, **key) -> DataFrame:
    """The rows of one key; the filter reaches the scan of stored rows."""
    return rows.where(reduce(Column.__and__, [F.col(k) == F.lit(v) for k, v in key.items()]))


def read(
    log: DataFrame, how: str, key, ordering, tiebreak=(), mode: str = "event",
    at: str | None = None, commits: DataFrame | None = None, recent: DataFrame | None = None,
    until: str | None = None, start: str | None = None, one_per_overwrite: bool = False,
) -> DataFrame:
    """T5-T8 over a change log, by name: ``snapshot``, ``as_of`` (needs ``at``) or
    ``incremental`` (the rows written after ``at``, as the table is now or, with
    ``until``, as it was then), or the reference's short names.

    ``commits`` is the commit list, if there is one apart from the rows (an
    overwrite without rows is only known from it); ``recent`` the rows of
    commits after ``at`` (and up to ``until``), if a cheaper scan has them;
    ``start`` is the newest overwrite commit up to the end of the read, if it is
    known ('': none is in the log); ``one_per_overwrite`` as in ``merge.resolve``."""
    how = READS.get(how, how)
    if how not in READS.values():
        raise ValueError(f"unknown read {how!r}; known: {sorted(READS.values())}")
    if how != "snapshot" and at is None:
        raise ValueError(f"the read {how!r} needs a commit time")
    if until is not None and how != "incremental":
        raise ValueError(f"the read {how!r} has no second commit time")
    end = at if how == "as_of" else until
    if end is not None:
        log = log.where(F.col(merge.COMMIT) <= F.lit(end))
        commits = commits.where(F.col(merge.COMMIT) <= F.lit(end)) if commits is not None else None
        recent = recent.where(F.col(merge.COMMIT) <= F.lit(end)) if recent is not None else None
    if commits is not None:
        start = merge.newest_overwrite(commits)
    if how == "incremental":
        return merge.resolve_since(log, key, ordering, tiebreak, mode, start, at, recent, one_per_overwrite)
    return merge.resolve(log, key, ordering, tiebreak, mode, start, one_per_overwrite)


def external_table(spark: SparkSession, name: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """Register stored parquet rows as an external table, with their partitions."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = spark.read.parquet(path)
    spark.catalog.createTable(name, path=path, source="parquet", schema=rows.schema) if not partition_by else spark.sql(
        f"CREATE TABLE {name} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}) "
        f"USING parquet PARTITIONED BY ({', '.join(partition_by)}) LOCATION '{path}'"
    )
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def temp_view(rows: DataFrame, name: str) -> None:
    """The rows as a session view."""
    rows.createOrReplaceTempView(name)
