"""File scans by extension, file <-> table, format conversion.

The reader is chosen from the file's extension (looking through ``.gz``,
which Spark's text-based readers decompress themselves). Reads are lazy
DataFrames; writes are Spark jobs. Nothing passes through the driver except
file *names*, streamed, when a listing is turned into one job per table or file.

Columns go by name: CSV files that are read together are grouped by their
header lines, parquet and orc schemas are merged. A file that can't be read is
reported, never left out in silence.
"""

from __future__ import annotations

import os
import warnings
from collections.abc import Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, StructField, StructType
from pyspark.errors import AnalysisException

from gridlake.functions import paths as P
from gridlake.sources import arrow_files, fs, store
from gridlake.sources.listing import list_objects

# File type -> (Spark source, default reader options). The CSV defaults are
# the reference's: a header line and inferred column types. Pass a schema to
# skip the inference pass over the data.
READERS: dict[str, tuple[str, dict[str, str]]] = {
    "csv": ("csv", {"header": "true", "inferSchema": "true"}),
    "txt": ("text", {}),
    "json": ("json", {}),
    "parquet": ("parquet", {"mergeSchema": "true"}),
    "orc": ("orc", {"mergeSchema": "true"}),
    "avro": ("avro", {}),
    "arrow": ("arrow_files", {}),
}
WRITERS: dict[str, tuple[str, dict[str, str]]] = {
    "csv": ("csv", {"header": "true"}),
    "txt": ("text", {}),
    "json": ("json", {}),
    "parquet": ("parquet", {}),
    "orc": ("orc", {}),
    "avro": ("avro", {}),
    "arrow": ("arrow_files", {}),
}

# The two-character null marker some CSV exports use (backslash, N).
CSV_NULL_MARKER = "\\N"


class MissingConnector(RuntimeError):
    """The format needs a connector jar that is not on the classpath."""


def _format_for(path: str, fmt: str | None) -> str:
    t = fmt or P.py_data_format(path)
    if not t:
        raise ValueError(f"cannot tell the format of {path!r}: no extension; pass fmt=")
    if t not in READERS:
        raise ValueError(f"unsupported format {t!r} for {path!r}; known: {sorted(READERS)}")
    return t


def _wrap_missing(fmt: str, exc: Exception) -> Exception:
    msg = str(exc)
    if "DATA_SOURCE_NOT_FOUND" in msg or "Failed to find data source" in msg:
        return MissingConnector(f"the {fmt!r} format needs its Spark connector package on the classpath")
    return exc


def scan(
    spark: SparkSession,
    path: str | list[str],
    fmt: str | None = None,
    schema: StructType | str | None = None,
    null_marker: str | None = None,
    **options: str,
) -> DataFrame:
    """Read a file, a folder, a glob or a list of files with the reader for their type.

    ``null_marker`` (CSV only) turns that string into NULL, e.g. ``"\\N"``;
    by default the marker is kept as text, so a column holding it stays a
    string. ``schema`` replaces CSV type inference, which otherwise reads
    the input once more before the real read: pass a schema for large
    inputs, or ``samplingRatio="0.01"`` to infer from a sample.

    CSV files with differing headers are read apart and united by column name;
    a column that some of them lack is NULL there.
    """
    first = path if isinstance(path, str) else path[0]
    t = _format_for(first, fmt)
    source, defaults = READERS[t]
    opts = dict(defaults)
    if schema is not None:
        opts.pop("inferSchema", None)
    if null_marker is not None and t == "csv":
        opts["nullValue"] = null_marker
    opts.update(options)
    if t == "arrow":
        opts |= arrow_options(spark)
    try:
        if t == "csv" and str(opts.get("header")).lower() == "true" and not _is_one_file(spark, path):
            groups = _by_header(spark, path, {k: v for k, v in opts.items() if k in FILE_OPTIONS})
            if len(groups) > 1:
                rest = {k: v for k, v in opts.items() if k not in FILE_OPTIONS}
                return _united([_load(spark, source, files, rest, schema, by_name=True) for files in groups])
        return _load(spark, source, path, opts, schema, by_name=t == "csv" and schema is not None)
    except AnalysisException as e:
        raise _wrap_missing(t, e) from e


def arrow_options(spark: SparkSession) -> dict[str, str]:
    """Make the Arrow source known to the session; what its tasks need of the session's settings."""
    arrow_files.register(spark)
    return store.settings(spark)


# Options that say which files are read.
FILE_OPTIONS = ("recursiveFileLookup", "pathGlobFilter", "modifiedBefore", "modifiedAfter")


def _is_one_file(spark: SparkSession, path: str | list[str]) -> bool:
    paths = [path] if isinstance(path, str) else path
    if len(paths) != 1:
        return False
    return not any(c in paths[0] for c in "*?[{") and not fs.is_dir(spark, paths[0])


def _by_header(spark: SparkSession, path: str | list[str], options: dict[str, str]) -> list[list[str]]:
    """The paths of CSV files, grouped by their first lines; none if all agree.

    Tasks read the heads of the files only (``store.heads``). If the first lines
    agree, which is told from a distinct count, no path is collected. Otherwise
    the driver holds the paths, as a reader's file index does.
    """
    found = spark.read.format("binaryFile").options(**options).load(path).select("path")  # names; no content is read
    if all(store.reachable(fs.qualify(spark, p)) for p in ([path] if isinstance(path, str) else path[:1])):
        heads = store.heads(found, store.settings(spark))
    else:
        lines = spark.read.format("text").options(**options).load(path)
        start = lines.select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("n"))
        heads = start.groupBy("path").agg(F.min_by("value", "n").alias("header"))
    if heads.agg(F.count_distinct("header").alias("n")).first().n <= 1:
        return []
    rows = heads.select("path", "header").orderBy("header", "path").toLocalIterator()
    return [[r.path for r in group] for _, group in groupby(rows, key=lambda r: r.header)]


def _load(
    spark: SparkSession, source: str, path: str | list[str], options: dict[str, str], schema: StructType | str | None, by_name: bool
) -> DataFrame:
    """One read. ``by_name`` gives the columns of a CSV header the types of the schema's fields of that name."""
    reader = spark.read.format(source).options(**options)
    if schema is None:
        return reader.load(path)
    if not by_name or str(options.get("header")).lower() != "true":
        return reader.schema(schema).load(path)
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kinds = {f.name: f.dataType for f in wanted}
    found = reader.option("inferSchema", "false").load(path).columns
    if not set(found) & set(kinds):  # a file without a header line of these names
        return reader.schema(wanted).load(path)
    here = StructType([StructField(c, kinds.get(c, StringType())) for c in found])
    rows = spark.read.format(source).options(**options).schema(here).load(path)
    return rows.select([F.col(f"`{f.name}`") if f.name in found else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted])


def _united(frames: list[DataFrame]) -> DataFrame:
    """Frames by column name; a column whose types differ, other than in the size of a number, is text."""
    kinds: dict[str, set] = {}
    for df in frames:
        for f in df.schema:
            kinds.setdefault(f.name, set()).add(f.dataType)
    as_text = {c for c, k in kinds.items() if len(k) > 1 and not all(isinstance(x, NumericType) for x in k)}
    out = None
    for df in frames:
        df = df.select([F.col(f"`{c}`").cast("string").alias(c) if c in as_text else F.col(f"`{c}`") for c in df.columns])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def _is_unsplittable(path: str | list[str]) -> bool:
    paths = [path] if isinstance(path, str) else path
    return any(P.py_file_type(p) in P.COMPRESSION_SUFFIXES for p in paths)


def spread(df: DataFrame, path: str | list[str]) -> DataFrame:
    """Rebalance rows read from unsplittable (gzip) files before writing.

    One gzip file is read by one task; without this, that task would also
    write all of its rows. AQE's rebalance cuts them into advisory-sized
    partitions. Splittable inputs are returned unchanged (no extra shuffle).
    """
    return df.hint("rebalance") if _is_unsplittable(path) else df


def query_file(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """``SELECT * FROM '<path>'`` (S4): SQL over a file with no table."""
    t = _format_for(path, fmt)
    source = READERS[t][0]
    if source in ("csv", "text", "arrow_files"):
        # Direct SQL on CSV has no header handling, and none on Python sources; use the reader instead.
        return scan(spark, path, t)
    return spark.sql(f"SELECT * FROM {source}.`{path}`")


def file_to_table(spark: SparkSession, path: str | list[str], table: str, fmt: str | None = None, **options) -> str:
    """Drop ``table`` if it exists, then create it from the file(s)."""
    df = spread(scan(spark, path, fmt, **options), path)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    df.write.mode("overwrite").saveAsTable(table)
    return table


def table_name_col(key) -> F.Column:
    """The table a file loads into: its base name without extension(s)
    (``raw/results.csv`` -> ``results``, ``a/races.csv.gz`` -> ``races``),
    made a valid table name: characters other than letters, digits and
    ``_`` become ``_``."""
    stem = P.base_name(key, with_extension=False)
    inner = P.base_name(stem, with_extension=False)
    name = F.when(P.file_type(key).isin(*P.COMPRESSION_SUFFIXES), inner).otherwise(stem)
    return F.regexp_replace(name, r"[^A-Za-z0-9_]", "_")


class SkippedFiles(UserWarning):
    """Objects that a bulk operation could not read."""


def objects_of(listing: DataFrame, formats: tuple[str, ...] = P.VALID_FORMATS, gz_format: str | None = None) -> DataFrame:
    """The objects of a listing: key, path, fmt, and a ``reason`` if they can't be read.

    A folder whose name has a data extension (``inputs/results.parquet/``) is a
    dataset that Spark wrote, and one object whatever it holds. A bare ``x.gz``
    doesn't say what it holds: ``gz_format`` does. Names that start with ``_``
    or ``.`` are invisible to Spark's readers. Files without a valid extension
    aren't data and aren't listed.
    """
    folder = F.regexp_extract("key", r"^(.*?[^/]\.(?:" + "|".join(sorted(READERS)) + r"))/", 1)
    inside = folder != ""
    key = F.when(inside, folder).otherwise(F.col("key"))
    cut = F.length("key") - F.length(key)
    found = listing.where(~F.col("is_dir")).select(
        key.alias("key"), F.left("path", F.length("path") - cut).alias("path")
    ).distinct().where(P.is_valid_format("key", formats))
    fmt = P.data_format("key")
    if gz_format:
        fmt = F.when(fmt == "", gz_format).otherwise(fmt)
    hidden = P.base_name("key").rlike("^[_.]")
    return found.withColumn("fmt", fmt).withColumn(
        "reason",
        F.when(hidden, "hidden from Spark's readers").when(F.col("fmt") == "", "no format inside .gz")
        .when(~F.col("fmt").isin(*READERS), "no reader for its format"),
    )


def _report_skipped(objects: DataFrame) -> None:
    skipped = objects.where("reason is not null")
    n = skipped.count()
    if n:
        some = ", ".join(f"{r.key} ({r.reason})" for r in skipped.orderBy("key").limit(10).collect())
        warnings.warn(f"{n} objects are not read: {some}{' ...' if n > 10 else ''}", SkippedFiles, stacklevel=3)


def bucket_to_tables(
    spark: SparkSession,
    root: str,
    database: str | None = None,
    prefix: str | None = None,
    formats: tuple[str, ...] = P.VALID_FORMATS,
    schemas: dict[str, StructType | str] | None = None,
    gz_format: str | None = None,
    parallelism: int = 4,
    **read_options: str,
) -> list[str]:
    """Load every object under ``root`` into a table named by its base name.

    Objects that share a base name (``2023/results.csv``, ``2024/results.csv``,
    ``inputs/results.parquet/``) make one table, their columns united by name.
    A name's characters other than letters, digits and ``_`` become ``_``
    (``lap-times.csv`` -> table ``lap_times``), as the catalog requires. Up to
    ``parallelism`` tables load at once, so the last tasks of one don't leave cores
    idle; the driver holds the paths of twice as many. ``schemas`` maps table names
    to known schemas (no inference pass), ``gz_format`` is the format of bare
    ``.gz`` files, ``read_options`` go to every reader. What can't be read is
    reported as a ``SkippedFiles`` warning.
    """
    objects = objects_of(list_objects(spark, root, prefix=prefix), formats, gz_format)
    _report_skipped(objects)
    rows = objects.where("reason is null").select(table_name_col(F.col("key")).alias("table"), "fmt", "path").orderBy("table", "fmt", "path")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    created = []

    def tables() -> Iterator[tuple[str, list[tuple[str, list[str]]]]]:
        for name, of_table in groupby(rows.toLocalIterator(), key=lambda r: r.table):
            created.append(f"{database}.{name}" if database else name)
            yield name, [(t, [r.path for r in of_format]) for t, of_format in groupby(of_table, key=lambda r: r.fmt)]

    def load(item) -> None:
        name, formats = item
        frames = [spread(scan(spark, paths, t, schema=(schemas or {}).get(name), **read_options), paths) for t, paths in formats]
        full = f"{database}.{name}" if database else name
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        _united(frames).write.mode("overwrite").saveAsTable(full)

    each(tables(), load, parallelism)
    return created


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", **options: str) -> str:
    if fmt not in WRITERS:
        raise ValueError(f"unsupported output format {fmt!r}")
    source, defaults = WRITERS[fmt]
    opts = {**defaults, **options}
    if fmt == "arrow":
        opts |= arrow_options(df.sparkSession)
    try:
        df.write.mode(mode).format(source).options(**opts).save(path)
    except AnalysisException as e:
        raise _wrap_missing(fmt, e) from e
    return path


def table_to_file(spark: SparkSession, table: str, path: str, fmt: str = "parquet", **options: str) -> str:
    """``COPY table TO path (FORMAT fmt)``."""
    return write(spark.table(table), path, fmt, **options)


def _join(root: str, key: str) -> str:
    return root.rstrip("/") + "/" + key.lstrip("/")


def converted_path(src_key: str, tgt_root: str, target_format: str, target_dir: str | None) -> str | None:
    """Target of converting ``src_key``; ``None`` when it has no extension."""
    if not P.py_extension(src_key):
        return None
    if target_dir is None:
        stem = src_key[: len(src_key) - len(P.py_extension(src_key))]
        return _join(tgt_root, f"{stem}.{target_format}")
    return _join(tgt_root, os.path.join(target_dir, f"{P.py_base_name(src_key, False)}.{target_format}"))


def convert_file(
    spark: SparkSession,
    src_root: str,
    src_key: str,
    tgt_root: str,
    target_dir: str | None = None,
    target_format: str = "parquet",
) -> str | None:
    """Convert one file to ``target_format``.

    Returns the target path, or ``None`` (nothing written) when the key has
    no extension, i.e. is not a file. Only the key's *last* extension is
    replaced when no ``target_dir`` is given.
    """
    tgt = converted_path(src_key, tgt_root, target_format, target_dir)
    if tgt is None:
        return None
    src = _join(src_root, src_key)
    write(spread(scan(spark, src), src), tgt, target_format)
    return tgt


def _targets(objects: DataFrame, tgt_root: str, target_dir: str | None, target_format: str) -> DataFrame:
    """The objects with a ``target`` each, no two alike.

    A target is named by the stem as long as that is unique; files that share
    it (``2023/results.csv``, ``2024/results.csv``) keep their source folder,
    and files that still share that (``a.csv``, ``a.json``) their full name.
    """
    key = F.col("key")
    folder = F.regexp_extract(key, r"^(.*/)?[^/]*$", 1)
    ending = F.lit(f".{target_format}")
    base = "" if target_dir is None else target_dir.strip("/") + "/"
    first = P.converted_key("key", target_format, None if target_dir is None else target_dir.rstrip("/"))
    names = [first, F.concat(F.lit(base), folder, P.base_name("key", False), ending), F.concat(F.lit(base), key, ending)]
    out = objects.withColumn("name", names[0])
    for other in names[1:]:
        shared = out.groupBy("name").count().where("count > 1").select("name", F.lit(True).alias("shared"))
        out = out.join(shared, "name", "left").withColumn("name", F.when(F.col("shared"), other).otherwise(F.col("name"))).drop("shared")
    return out.withColumn("target", F.concat(F.lit(tgt_root.rstrip("/") + "/"), "name")).drop("name")


def _refuse_shared_targets(targets: DataFrame) -> None:
    twice = targets.groupBy("target").count().where("count > 1").select("target").limit(5).collect()
    if twice:
        raise ValueError(f"several inputs would be written to {[r.target for r in twice]}; nothing was written")


def each(work: Iterator, run, parallelism: int) -> None:
    """Run the items of a stream as concurrent Spark jobs, with few of them in hand at a time."""
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        running = set()
        for item in work:
            running.add(pool.submit(run, item))
            if len(running) >= 2 * max(1, parallelism):
                done, running = wait(running, return_when=FIRST_COMPLETED)
                for x in done:
                    x.result()
        for x in running:
            x.result()


def bulk_convert(
    spark: SparkSession,
    src_root: str,
    tgt_root: str,
    target_dir: str | None = "inputs/",
    target_format: str = "parquet",
    prefix: str | None = None,
    formats: tuple[str, ...] = P.VALID_FORMATS,
    parallelism: int = 4,
    by_folder: bool = False,
    gz_format: str | None = None,
) -> DataFrame:
    """Convert every object of a valid format under ``src_root``.

    Per file (default, the reference's behaviour): each file becomes its own
    dataset at its converted key, one Spark job per file, up to
    ``parallelism`` at once; targets are unique (see ``_targets``), and it is
    checked before anything is written. ``by_folder=True`` is the mode for
    many small files: the files of one folder and one format are converted by
    a single job, columns by name, into one dataset at
    ``tgt_root/<folder>.<target_format>``. Returns ``(key, target, reason)``
    rows; an object that can't be read has a reason and no target, and a
    ``SkippedFiles`` warning says so.
    """
    if by_folder and prefix and not prefix.endswith("/"):
        raise ValueError("by_folder converts whole folders: the prefix must end with '/'")
    objects = objects_of(list_objects(spark, src_root, prefix=prefix), formats, gz_format)
    _report_skipped(objects)
    good = objects.where("reason is null")
    if by_folder:
        folder = F.regexp_extract("key", r"^(.*)/[^/]*$", 1)
        placed = good.withColumn("folder", folder)
        several = placed.groupBy("folder").agg((F.count_distinct("fmt") > 1).alias("several"))
        name = F.when(F.col("folder") == "", "_root").otherwise(F.col("folder"))
        name = F.when(F.col("several"), F.concat_ws(".", name, "fmt")).otherwise(name)
        target = F.concat(F.lit(tgt_root.rstrip("/") + "/"), name, F.lit(f".{target_format}"))
        targets = placed.join(several, "folder").withColumn("target", target)
        _refuse_shared_targets(targets.select("target", "folder", "fmt").distinct())
    else:
        targets = _targets(good, tgt_root, target_dir, target_format)
        _refuse_shared_targets(targets)
    rows = targets.select("target", "fmt", "path").orderBy("target", "fmt", "path").toLocalIterator()
    work = (((target, fmt), [r.path for r in group]) for (target, fmt), group in groupby(rows, key=lambda r: (r.target, r.fmt)))

    def convert(item) -> None:
        (target, fmt), paths = item
        write(spread(scan(spark, paths if len(paths) > 1 else paths[0], fmt), paths), target, target_format)

    each(work, convert, parallelism)
    return targets.select("key", "target", "reason").unionByName(
        objects.where("reason is not null").select("key", F.lit(None).cast("string").alias("target"), "reason")
    )


# Keyed-table storage defaults (fixed values from the reference's table options).
MAX_FILE_BYTES = 26_214_400
BLOCK_BYTES = 26_214_400
RECORD_SIZE_ESTIMATE = 512
TABLE_CODEC = "snappy"


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: list[str] | tuple[str, ...] = ("year",),
    mode: str = "overwrite",
    codec: str = TABLE_CODEC,
    max_file_bytes: int = MAX_FILE_BYTES,
    record_size: int = RECORD_SIZE_ESTIMATE,
    cluster_by: list[str] | tuple[str, ...] = (),
    bloom: list[str] | tuple[str, ...] = (),
    bloom_keys: int = 1 << 20,
    dynamic: bool = False,
) -> str:
    """Columnar write partitioned by derived date parts.

    Rows are rebalanced by the partition columns first, so a partition comes
    from few tasks (and a large one from several) instead of every task
    writing a small file for each. Files are capped at about
    ``max_file_bytes`` via a row cap computed from the per-record size
    estimate; row groups are ``BLOCK_BYTES``. ``cluster_by`` sorts the rows
    of a file, so lookups by these columns skip row groups. ``bloom`` columns
    get a Bloom filter for each row group (sized for ``bloom_keys`` keys at
    most, and for fewer where there are fewer), so a lookup skips row groups
    whatever the order of the rows. ``dynamic`` overwrites only the partitions
    that ``df`` has rows for.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if cluster_by:
        df = df.sortWithinPartitions(*partition_by, *cluster_by)
    (
        df.write.mode(mode)
        .partitionBy(*partition_by)
        .option("compression", codec)
        .option("maxRecordsPerFile", max(1, max_file_bytes // max(1, record_size)))
        .option("parquet.block.size", str(BLOCK_BYTES))
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .options(**{f"parquet.bloom.filter.{k}#{c}": v for c in bloom for k, v in (("enabled", "true"), ("adaptive.enabled", "true"), ("expected.ndv", str(bloom_keys)))})
        .parquet(path)
    )
    return path


def add_date_parts(df: DataFrame, ts_col: str, parts: list[str] | tuple[str, ...] = ("year",)) -> DataFrame:
    """Derive ``year`` / ``month`` / ``day`` partition columns from a timestamp."""
    fns = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    for p in parts:
        if p not in fns:
            raise ValueError(f"unknown date part {p!r}")
        df = df.withColumn(p, fns[p](F.col(ts_col)))
    return df
