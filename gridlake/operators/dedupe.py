"""Deterministic de-duplication by key (A4).

``dropDuplicates`` keeps an arbitrary row per key. Here the surviving row is
the one with the greatest ordering value (NULL lowest), then the greatest
tie-break. It is the first row of a ranking, which Spark cuts off before the
shuffle as well (``WindowGroupLimit``): a key holding a third of all rows is
reduced inside every input task and sends one row per task across the network
instead of all of its rows to a single reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_key(ordering: Sequence[str], tiebreak: Sequence[str] = ()) -> Column:
    """A struct that sorts like ``ORDER BY ordering NULLS FIRST, tiebreak``.

    Each ordering column is preceded by an is-not-null flag so NULL sorts
    lowest regardless of the engine's struct-null convention.
    """
    fields = []
    for i, c in enumerate(list(ordering) + list(tiebreak)):
        fields.append(F.col(c).isNotNull().alias(f"_n{i}"))
        fields.append(F.col(c).alias(f"_v{i}"))
    return F.struct(*fields)


def latest_per_key(
    df: DataFrame,
    key: Sequence[str] | str,
    ordering: Sequence[str] | str,
    tiebreak: Sequence[str] | str = (),
) -> DataFrame:
    """One row per key: greatest ``ordering``, then greatest ``tiebreak``.

    Rows whose key is NULL are kept as one group (SQL grouping semantics).
    """
    keys = [key] if isinstance(key, str) else list(key)
    ords = [ordering] if isinstance(ordering, str) else list(ordering)
    ties = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    best = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in ords + ties])
    return df.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") == 1).drop("_rank")
