"""A rank over all rows without a single-partition window.

Spark's ``row_number() over (order by ...)`` brings every row to one task. Here
the rows are range-partitioned by the order, which a sort does anyway, numbered
inside their partition, and each partition's first number comes from the counts
of the partitions before it (one row per partition).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def global_rank(df: DataFrame, order: list[Column], write: Callable[[DataFrame, str], DataFrame], name: str = "rank") -> DataFrame:
    """``df`` with ``rank`` (long, from 1), its place among all rows in the given order.

    The order should be total: rows that tie get different ranks, in any order.
    ``write`` stores the partitioned rows and reads them again (its arguments
    are a frame and a name), because both the counts and the ranks read them and
    a second range partitioning could cut elsewhere. The driver holds nothing.
    """
    parts = write(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), f"{name}-parts")
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    ranked = parts.withColumn("_own", own).join(starts, "_part")
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_start") + F.col("_own")).cast("long").alias("rank"))
