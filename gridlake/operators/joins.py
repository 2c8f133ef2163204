"""Star joins.

No dimension is broadcast on faith: the planner makes two size checks of its
own, the static one against ``spark.sql.autoBroadcastJoinThreshold`` from
relation statistics and the runtime one in AQE against the measured shuffle
output. When both say "big", the join stays a sort-merge join and AQE splits
skewed partitions of the fact side, so a dimension that grows with the data
never ends up copied to every executor.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Dim:
    """One dimension of a star join.

    ``key`` is the join column, present under the same name on both sides
    (SQL ``USING``: the key is kept once).
    """

    df: DataFrame
    key: str


def join_dim(fact: DataFrame, dim: Dim) -> DataFrame:
    """Inner equi-join ``fact JOIN dim USING (key)``."""
    return fact.join(dim.df, on=dim.key, how="inner")


def star_join(fact: DataFrame, dims: list[Dim]) -> DataFrame:
    """Join ``fact`` with each dimension in turn (inner, ``USING`` semantics).

    Orphan or NULL keys drop; duplicate dimension keys multiply rows, as in SQL.
    Put the dimension that shares the fact's existing partitioning first: a
    sort-merge join on the same key reuses the fact's exchange.
    """
    out = fact
    for d in dims:
        out = join_dim(out, d)
    return out
