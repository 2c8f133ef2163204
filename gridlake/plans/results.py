"""Rows at the edge.

Queries stay lazy DataFrames everywhere in the library; a relation from SQL
(X1) is ``spark.sql`` and a pandas frame (X3) is ``DataFrame.toPandas``, which
need no wrapper. What the reference's fetch adds is its reading of the number
of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row


def fetch(df: DataFrame, num_rows: int | None = 1) -> Row | list[Row] | None:
    """``num_rows`` falsy -> every row, 1 -> one row, n -> up to n rows.

    Every-row mode brings the whole result to the driver: use it for
    report-sized results only.
    """
    if not num_rows:
        return df.collect()
    if num_rows == 1:
        return df.first()
    return df.take(num_rows)
