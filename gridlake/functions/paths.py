"""Path and object-key expressions over a column of paths.

These run inside Spark on a listing DataFrame (one row per file), so a
bucket with millions of objects is processed in parallel instead of in a
Python loop. The extension rules follow ``os.path.splitext`` applied to the
last path component: the extension starts at the last dot, and leading dots
of the file name do not start one (``.bashrc`` has none).
"""

from __future__ import annotations

import os

from pyspark.sql import Column
from pyspark.sql import functions as F

# The file formats accepted for loading and conversion.
VALID_FORMATS = ("csv", "parquet", "json", "txt", "orc", "gz", "avro")

# Suffixes of compression codecs that Spark's readers decompress themselves.
COMPRESSION_SUFFIXES = ("gz",)

# Leading dots, at least one other character, then the last ".xxx".
_EXT = r"^\.*[^.].*(\.[^.]*)$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _drop_suffix(s: Column, suffix: Column) -> Column:
    return F.left(s, F.length(s) - F.length(suffix))


def base_name(path: Column | str, with_extension: bool = True) -> Column:
    """Last path component; with ``with_extension=False``, without its extension."""
    name = F.regexp_extract(_c(path), r"([^/]*)$", 1)
    if with_extension:
        return name
    return _drop_suffix(name, F.regexp_extract(name, _EXT, 1))


def extension(path: Column | str) -> Column:
    """Extension with its dot (``.csv``), or ``''`` when there is none."""
    return F.regexp_extract(base_name(path), _EXT, 1)


def file_type(path: Column | str) -> Column:
    """Extension without the dot (``csv``), or ``''``."""
    return F.regexp_replace(extension(path), r"^\.", "")


def strip_extension(path: Column | str) -> Column:
    """The path without its last extension (``a/b.csv`` -> ``a/b``)."""
    return _drop_suffix(_c(path), extension(path))


def data_format(path: Column | str) -> Column:
    """The format to read a file with: its type, looking through ``.gz``.

    ``x.csv.gz`` -> ``csv``. A bare ``x.gz`` has no inner type and gives ``''``.
    """
    t = file_type(path)
    inner = file_type(strip_extension(path))
    return F.when(t.isin(*COMPRESSION_SUFFIXES), inner).otherwise(t)


def is_valid_format(path: Column | str, formats: tuple[str, ...] = VALID_FORMATS) -> Column:
    """The file's real extension is one of ``formats``.

    A name that merely ends in the letters (``xcsv``) does not qualify.
    """
    return file_type(path).isin(*formats)


def object_uri(bucket: Column | str, key: Column | str, scheme: str = "s3") -> Column:
    """``s3://bucket/key``."""
    return F.concat(F.lit(f"{scheme}://"), _c(bucket), F.lit("/"), _c(key))


def converted_key(key: Column | str, target_format: str, target_dir: str | None = None) -> Column:
    """Key of a converted file.

    Without ``target_dir``: the same key with its last extension replaced
    (``in/a.csv`` -> ``in/a.parquet``). With it: ``target_dir/<stem>.<fmt>``.
    A key without an extension gives NULL: it is not a file to convert.
    """
    k = _c(key)
    has_ext = extension(k) != F.lit("")
    if target_dir is None:
        out = F.concat(strip_extension(k), F.lit(f".{target_format}"))
    else:
        prefix = target_dir if target_dir.endswith("/") or not target_dir else target_dir + "/"
        out = F.concat(F.lit(prefix), base_name(k, with_extension=False), F.lit(f".{target_format}"))
    return F.when(has_ext, out)


# Plain-Python versions for the driver side, where a single path is at hand
# (e.g. choosing the reader for one file). Same rules as the expressions.
def py_extension(path: str) -> str:
    return os.path.splitext(os.path.basename(path))[1]


def py_file_type(path: str) -> str:
    return os.path.splitext(os.path.basename(path))[1].lstrip(".")


def py_data_format(path: str) -> str:
    t = py_file_type(path)
    if t in COMPRESSION_SUFFIXES:
        return py_file_type(os.path.splitext(os.path.basename(path))[0])
    return t


def py_base_name(path: str, with_extension: bool = True) -> str:
    name = os.path.basename(path)
    return name if with_extension else os.path.splitext(name)[0]
