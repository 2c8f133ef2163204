"""Database export and import.

An export writes every table of the chosen databases to
``<dir>/<database>/<table>/`` in one format, plus a ``manifest`` dataset (one
row per table or view: its schema and partition columns, or its SQL) from which
``import_database`` re-creates the tables as they were and then the views. Each
table is one distributed write; the manifest is metadata-sized.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from gridlake.sources.files import READERS, arrow_options, write

# The reference's parquet export settings.
PARQUET_EXPORT_OPTIONS = {"compression": "zstd", "parquet.block.row.count.limit": "100000"}
# Fixed value: the delimiter of its CSV export.
CSV_EXPORT_DELIMITER = "||"
# What a NULL is in a CSV export, so that it differs from an empty text. A
# table that holds this very text is refused.
CSV_EXPORT_NULL = "\u2400"

CSV_OPTIONS = {
    "sep": CSV_EXPORT_DELIMITER, "header": "true", "nullValue": CSV_EXPORT_NULL, "emptyValue": "", "escape": '"', "quoteAll": "true",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
EXPORT_OPTIONS: dict[str, dict[str, str]] = {
    "parquet": PARQUET_EXPORT_OPTIONS,
    "csv": CSV_OPTIONS,
    "json": JSON_OPTIONS | {"ignoreNullFields": "false"},
    "orc": {},
    "avro": {},
    "arrow": {},
}
# Fields of an export may hold line breaks; quoted, they stay inside a record.
IMPORT_OPTIONS: dict[str, dict[str, str]] = {"csv": CSV_OPTIONS | {"multiLine": "true", "enforceSchema": "false"}, "json": JSON_OPTIONS}

MANIFEST = "manifest"
MANIFEST_SCHEMA = (
    "database string, name string, kind string, format string, path string, view_sql string, schema string, partitions array<string>"
)


def _objects(spark: SparkSession, databases: list[str]) -> list[tuple[str, str, str]]:
    out = []
    for db in databases:
        for t in spark.catalog.listTables(db):
            if t.isTemporary:
                continue
            out.append((db, t.name, "view" if (t.tableType or "").upper() == "VIEW" else "table"))
    return out


def _view_sql(spark: SparkSession, db: str, name: str) -> str:
    return spark.sql(f"SHOW CREATE TABLE {db}.{name}").first()[0]


def _partitions(spark: SparkSession, db: str, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(f"{db}.{name}") if c.isPartition]


def _refuse_marker(df: DataFrame, name: str) -> None:
    """CSV can't tell a text that equals the marker from NULL: such a table isn't exported."""
    held = [F.col(f"`{f.name}`") == CSV_EXPORT_NULL for f in df.schema if isinstance(f.dataType, StringType)]
    cond = F.lit(False)
    for c in held:
        cond = cond | F.coalesce(c, F.lit(False))
    if held and df.where(cond).limit(1).count():
        raise ValueError(f"{name} holds the text {CSV_EXPORT_NULL!r}, which stands for NULL in a CSV export")


def export_database(
    spark: SparkSession,
    out_dir: str,
    databases: list[str] | None = None,
    fmt: str = "parquet",
    parallelism: int = 4,
) -> DataFrame:
    """Write each table to ``out_dir`` in ``fmt`` and a manifest; return it.

    Tables are independent writes, so up to ``parallelism`` run as
    concurrent Spark jobs; the manifest is written last, after every table.
    """
    if fmt not in EXPORT_OPTIONS:
        raise ValueError(f"unsupported export format {fmt!r}")
    if databases is None:
        databases = [d.name for d in spark.catalog.listDatabases()]
    base = out_dir.rstrip("/")
    objects = _objects(spark, databases)
    rows = [(db, name, kind, None, None, _view_sql(spark, db, name), None, None) for db, name, kind in objects if kind == "view"]

    def one(obj):
        db, name, kind = obj
        path, df = f"{db}/{name}", spark.table(f"{db}.{name}")
        if fmt == "csv":
            _refuse_marker(df, f"{db}.{name}")
        write(df, f"{base}/{path}", fmt, **EXPORT_OPTIONS[fmt])
        return (db, name, kind, fmt, path, None, df.schema.json(), _partitions(spark, db, name))

    tables = [o for o in objects if o[2] == "table"]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        rows += list(pool.map(one, tables))
    manifest = spark.createDataFrame(rows, MANIFEST_SCHEMA)
    manifest.coalesce(1).write.mode("overwrite").json(f"{base}/{MANIFEST}")
    return manifest


def import_database(spark: SparkSession, in_dir: str, parallelism: int = 4) -> list[str]:
    """Re-create the exported tables (concurrently), then the views."""
    base = in_dir.rstrip("/")
    manifest = spark.read.schema(MANIFEST_SCHEMA).json(f"{base}/{MANIFEST}")
    entries = sorted(manifest.collect(), key=lambda r: (r.database, r.name))  # one row per table or view
    for db in sorted({e.database for e in entries}):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")

    def table(e) -> str:
        full = f"{e.database}.{e.name}"
        schema = StructType.fromJson(json.loads(e.schema))
        # The path is relative to the export, which may have been moved.
        options = arrow_options(spark) if e.format == "arrow" else IMPORT_OPTIONS.get(e.format, {})
        df = spark.read.format(READERS[e.format][0]).options(**options).schema(schema).load(f"{base}/{e.path}")
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        w = df.write.mode("overwrite")
        (w.partitionBy(*e.partitions) if e.partitions else w).saveAsTable(full)
        return full

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        done = list(pool.map(table, [e for e in entries if e.kind == "table"]))
    # A view may read another view: create what can be created, retry the
    # rest, stop when a pass makes no progress.
    pending = [e for e in entries if e.kind == "view"]
    while pending:
        failed, last_error = [], None
        for e in pending:
            full = f"{e.database}.{e.name}"
            try:
                spark.sql(f"DROP VIEW IF EXISTS {full}")
                spark.sql(e.view_sql)
                done.append(full)
            except AnalysisException as exc:
                failed.append(e)
                last_error = exc
        if len(failed) == len(pending):
            raise last_error
        pending = failed
    return done
