"""A key holding a third of all rows must not pin one task.

These tests lower AQE's skew thresholds so that small local data counts as
skewed, run the plans, and check that (a) the final adaptive plan split the
hot partition and (b) the result is the same as without splitting.
"""

import re

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from gridlake.keyed.merge import resolve
from gridlake.plans import facts, racing, reports

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "32",
}


@pytest.fixture()
def skew_conf(spark: SparkSession):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df) -> str:
    df.collect()  # runs this DataFrame's own query execution
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan
    return plan


def _hot_log(spark, n=200_000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000).alias("k"),
        (F.col("id") % 97).alias("ord"),
        F.col("id").alias("tb"),
        F.when(F.col("id") % 7 == 0, "U").otherwise("I").alias("_op"),
    ).withColumn("_commit_time", F.when(F.col("_op") == "U", "20240101000000002").otherwise("20240101000000001"))


def test_keyed_resolve_splits_hot_key(spark, skew_conf):
    log = _hot_log(spark)
    df = resolve(log, "k", "ord", "tb", "event", start="")
    plan = _final_plan(df)
    assert re.search(r"SortMergeJoin\(skew=true\)", plan), plan
    # same rows as with the default thresholds
    got = df.groupBy("_op").count().collect()
    for k in SKEW_CONF:
        if k != "spark.sql.shuffle.partitions":
            spark.conf.unset(k)
    want = resolve(log, "k", "ord", "tb", "event", start="").groupBy("_op").count().collect()
    assert sorted(got) == sorted(want)


def test_star_join_splits_hot_driver(spark, skew_conf):
    n = 120_000
    base = spark.range(n)
    results = base.select(
        F.col("id").alias("resultId"),
        (F.col("id") % 500).alias("raceId"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 800).alias("driverId"),
        (F.col("id") % 20).alias("constructorId"),
        F.lit(1).cast("bigint").alias("statusId"),
        (F.col("id") % 20 + 1).alias("grid"),
        F.lit("1").alias("position"),
        F.lit("1").alias("positionText"),
        (F.col("id") % 10 + 1).alias("positionOrder"),
        (F.col("id") % 26).cast("double").alias("points"),
        F.lit(50).cast("bigint").alias("laps"),
        F.lit("1:30").alias("time"),
        F.col("id").cast("string").alias("milliseconds"),
        F.lit("40").alias("fastestLap"),
        (F.col("id") % 20 + 1).cast("string").alias("rank"),
        F.lit("1:20").alias("fastestLapTime"),
        F.lit("210").alias("fastestLapSpeed"),
    )
    sprint = results.limit(0).drop("rank", "fastestLapSpeed")
    t = racing.RacingTables(
        results=results,
        sprint_results=sprint,
        qualifying=spark.createDataFrame([], "qualifyId bigint, raceId bigint, driverId bigint, constructorId bigint, position bigint, q1 string, q2 string, q3 string"),
        races=spark.range(500).select(F.col("id").alias("raceId"), F.lit(2024).cast("bigint").alias("year"), F.concat(F.lit("GP"), F.col("id").cast("string")).alias("name")),
        drivers=spark.range(800).select(F.col("id").alias("driverId"), F.lit("D").alias("forename"), F.col("id").cast("string").alias("surname")),
        constructors=spark.range(20).select(F.col("id").alias("constructorId"), F.col("id").cast("string").alias("name")),
        status=spark.createDataFrame([(1, "Finished")], "statusId bigint, status string"),
    )
    rf = facts.result_facts(t)
    plan = _final_plan(rf)
    assert re.search(r"SortMergeJoin\(skew=true\)", plan), plan
    top = reports.driver_points(rf).first()
    assert top.driver_name == "D 1"
