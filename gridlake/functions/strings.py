"""String helpers used by the fact builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def concat_sql(*parts: Column | str) -> Column:
    """SQL ``a || b || ...``: non-strings are cast, any NULL makes the result NULL.

    ``concat`` has exactly these semantics; ``concat_ws`` would skip NULLs,
    which is not what ``||`` does.
    """
    cols = [p if isinstance(p, Column) else F.col(p) for p in parts]
    return F.concat(*[c.cast("string") for c in cols])


def spaced(a: Column | str, b: Column | str) -> Column:
    """``a || ' ' || b`` (race and driver names)."""
    return concat_sql(a, F.lit(" "), b)


def null_of(dtype: DataType | str) -> Column:
    """A typed NULL literal, so a UNION branch keeps the other branch's type."""
    return F.lit(None).cast(dtype)
