"""How many tasks a step gets by the size of its input.

A session's number of shuffle partitions is fixed, and what AQE makes of it
goes by compressed bytes, so a task that holds rows in memory (an aggregate on
wide rows, say) holds more of them as the input grows. A step of that kind asks
for partitions by the bytes of the files that it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

PER_TASK = 4 << 20  # bytes of input files
MOST = 1 << 14  # partitions; beyond them Spark's aggregates spill
_UNKNOWN = 1 << 62


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of the relations that a frame reads, as the planner knows them; nothing is run or listed.

    A relation that is read twice counts twice. None if the planner doesn't know the size of one.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return None if any(n >= _UNKNOWN for n in sizes) else sum(sizes)


def distinct_by_size(df: DataFrame, by: list[str]) -> DataFrame:
    """``df.distinct()`` in as many tasks as the input's size asks for.

    Rows are dealt by the columns ``by``, some of their own, before any of them is held, so the step
    that makes them holds none. Give all columns that tell rows apart: what many rows share in
    one of them is then no bottleneck.
    """
    size = input_bytes(df)
    if size is None:
        return df.distinct()
    return df.repartition(min(MOST, max(1, -(-size // PER_TASK))), *[f"`{c}`" for c in by]).distinct()
