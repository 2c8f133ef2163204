import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from gridlake.operators import partitions
from gridlake.plans import facts, racing, roundtrips


@pytest.fixture
def tables(spark, tmp):
    """Results over files: 600 rows of 60 races, every row twice."""
    n = spark.range(600)
    li = n.select(
        (F.col("id") % 60).alias("l_orderkey"), (F.col("id") % 7).alias("l_partkey"), (F.col("id") % 5).alias("l_suppkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"), (F.col("id") % 50).cast("double").alias("l_quantity"),
        (F.col("id") / 3).alias("l_extendedprice"), F.lit(0.04).alias("l_discount"), F.lit(0.02).alias("l_tax"),
        F.when(F.col("id") % 2 == 0, "N").otherwise("R").alias("l_returnflag"), F.lit("F").alias("l_linestatus"),
    )
    li.unionByName(li).write.parquet(f"{tmp}/lineitem.parquet")
    spark.range(60).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"), F.lit(dt.date(1997, 1, 1)).alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")
    ).write.parquet(f"{tmp}/orders.parquet")
    spark.range(9).select(F.col("id").alias("c_custkey"), F.lit("A").alias("c_mktsegment"), F.col("id").cast("string").alias("c_name")).write.parquet(f"{tmp}/customer.parquet")
    spark.range(5).select(F.col("id").alias("s_suppkey"), F.col("id").cast("string").alias("s_name")).write.parquet(f"{tmp}/supplier.parquet")
    spark.range(7).select(F.col("id").alias("p_partkey"), F.lit("TIN").alias("p_type")).write.parquet(f"{tmp}/part.parquet")
    return racing.from_tpch(spark, str(tmp))


def test_distinct_facts_are_held_by_as_many_tasks_as_the_input_asks_for(spark, tables, monkeypatch):
    rows = facts.result_facts(tables)
    assert rows.count() == 600 and rows.select("resultId", "fastestLapTime").distinct().count() == 600
    size = partitions.input_bytes(facts._result_rows(facts._tagged_results(tables.results, "Normal race", sprint=False), tables))
    for tasks in (3, 9):
        monkeypatch.setattr(partitions, "PER_TASK", size // tasks + 1)
        rows = facts.result_facts(tables)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        # Both tables' rows are dealt once, in that many parts, and no aggregate is below the exchange that deals them.
        assert plan.count("REPARTITION_BY_NUM") == 2 and plan.count(f", {tasks}), REPARTITION_BY_NUM") == 2
        below = plan.split("REPARTITION_BY_NUM", 1)[1].split("REPARTITION_BY_NUM", 1)[0]
        assert "ENSURE_REQUIREMENTS" not in plan.split("REPARTITION_BY_NUM", 1)[0] and below.count("HashAggregate") == 2  # those of the other table
        assert rows.count() == 600


def test_inputs_of_unknown_size_keep_the_sessions_partitions(spark):
    rows = spark.createDataFrame(spark.sparkContext.parallelize([(1, "a"), (1, "a"), (2, "a")]), "x int, s string")
    assert partitions.input_bytes(rows) is None
    assert sorted(partitions.distinct_by_size(rows, ["x", "s"]).collect()) == [(1, "a"), (2, "a")]


def test_a_folder_of_many_objects_is_written_by_several_tasks(spark, tmp, monkeypatch):
    monkeypatch.setattr(roundtrips, "PER_FILE", 5)
    monkeypatch.setattr(roundtrips, "PER_BLOCK", 10)
    n = F.col("id")
    # Two folders: one for a null status (its keys end with 1), one with nine tenths of the rows' twins.
    spark.range(0, 1030, 10, 4).select(
        F.when(n < 100, n + 1).otherwise(n).alias("o_orderkey"), n.alias("o_custkey"), F.when(n >= 100, "O").alias("o_orderstatus")
    ).write.parquet(f"{tmp}/orders.parquet")
    root = roundtrips._many_objects(spark, str(tmp), "several")
    root = root.removeprefix("file:")
    found = {f: sorted(glob.glob(f"{root}/{f}/*.parquet")) for f in ("status=O/digit=0", "status=__HIVE_DEFAULT_PARTITION__/digit=1")}
    for rows, files in zip((93, 10), found.values(), strict=True):
        sizes = sorted(spark.read.parquet(f).count() for f in files)
        assert len(files) == -(-rows // 5) and sum(sizes) == rows and sizes[1:] == [5] * (len(files) - 1)
    tasks = {os.path.basename(f).split("-")[1] for f in found["status=O/digit=0"]}
    assert len(tasks) > 1
