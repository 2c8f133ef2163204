import glob
import os

import pytest
from pyspark.sql import functions as F

from gridlake.keyed import ops, stored
from gridlake.operators.ranking import global_rank
from gridlake.sources import files

SCHEMA = "k long, at int, v string, day int"


def rows_of(spark, path):
    return sorted((r.k, r.at, r.v, r.day) for r in spark.read.parquet(path).collect())


def files_of(path):
    return {d: set(os.path.basename(f) for f in glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{path}/day=*")}


@pytest.mark.parametrize("mode", ["event", "commit"])
def test_an_upsert_rewrites_touched_partitions_only(spark, tmp, mode):
    old = [(k, k % 5, f"old{k}", k % 10) for k in range(200)]
    files.write_partitioned(spark.createDataFrame(old, SCHEMA), f"{tmp}/t", ["day"])
    before = files_of(f"{tmp}/t")
    batch = [(3, 9, "new", 7), (3, 1, "worse", 1), (13, 0, "late", 4), (1000, 1, "added", 12), (1001, None, "null", None)]
    n = stored.upsert_stored(spark, f"{tmp}/t", spark.createDataFrame(batch, SCHEMA), "k", "at", partition_by=["day"], mode=mode)
    rows = ops.upsert(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(batch, SCHEMA), "k", "at", mode=mode)
    by = lambda r: tuple((x is not None, x) for x in r)
    got = [(r.k, r.at, r.v, r.day) for r in spark.read.parquet(f"{tmp}/t").collect()]
    assert sorted(got, key=by) == sorted(map(tuple, rows.collect()), key=by)
    after = files_of(f"{tmp}/t")
    same = {d for d in before if before[d] == after[d]}
    assert {os.path.basename(d) for d in same} == {f"day={i}" for i in (0, 1, 2, 5, 6, 8, 9)}
    assert n == 5 and not os.path.exists(f"{tmp}/t/day=11")


def test_a_partition_that_all_keys_leave_goes(spark, tmp):
    files.write_partitioned(spark.createDataFrame([(1, 1, "a", 1), (2, 1, "b", 2)], SCHEMA), f"{tmp}/t", ["day"])
    stored.upsert_stored(spark, f"{tmp}/t", spark.createDataFrame([(1, 2, "c", 2)], SCHEMA), "k", "at", partition_by=["day"])
    assert rows_of(spark, f"{tmp}/t") == [(1, 2, "c", 2), (2, 1, "b", 2)] and not os.path.exists(f"{tmp}/t/day=1")
    assert stored.delete_stored(spark, f"{tmp}/t", spark.createDataFrame([(5,)], "k long"), "k", ["day"]) == 0
    assert stored.delete_stored(spark, f"{tmp}/t", spark.createDataFrame([(2,)], "k long"), "k", ["day"]) == 1
    assert rows_of(spark, f"{tmp}/t") == [(1, 2, "c", 2)]


def test_null_keys_change_nothing(spark, tmp):
    files.write_partitioned(spark.createDataFrame([(1, 1, "a", 1)], SCHEMA), f"{tmp}/t", ["day"])
    before = files_of(f"{tmp}/t")
    with pytest.raises(Exception, match="k is NULL"):
        stored.upsert_stored(spark, f"{tmp}/t", spark.createDataFrame([(None, 2, "c", 1)], SCHEMA), "k", "at", partition_by=["day"])
    assert files_of(f"{tmp}/t") == before


def scanned(df):
    """Rows that a frame's scan gave."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().apply(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_bloom_filters_skip_row_groups(spark, tmp):
    rows = spark.range(200_000).select(F.concat(F.lit("key-"), F.xxhash64("id")).alias("k"), F.lit(1).alias("p")).repartition(4)
    for name, bloom in (("with", ["k"]), ("without", [])):
        files.write_partitioned(rows, f"{tmp}/{name}", ["p"], bloom=bloom, max_file_bytes=20_000 * 512)
    present = rows.first().k
    lookups = {n: [ops.lookup(spark.read.parquet(f"{tmp}/{n}"), k=k) for k in (present, present + "0")] for n in ("with", "without")}
    assert [df.count() for df in lookups["with"]] == [df.count() for df in lookups["without"]] == [1, 0]
    some, none = (scanned(df) for df in lookups["with"])
    assert none == 0 and some <= 20_000 and all(scanned(df) == 200_000 for df in lookups["without"])


def test_a_global_rank_equals_a_sort(spark, tmp):
    def write(df, name):
        df.write.mode("overwrite").parquet(f"{tmp}/{name}")
        return spark.read.schema(df.schema).parquet(f"{tmp}/{name}")

    rows = spark.range(5_000).select((F.xxhash64("id") % 700).alias("x"), "id", F.when(F.col("id") % 9 > 0, "a").alias("s")).repartition(6)
    order = [F.col("s").asc_nulls_last(), F.col("x").desc(), F.col("id").asc()]
    got = [(r.s, r.x, r.id) for r in sorted(global_rank(rows, order, write).collect(), key=lambda r: r.rank)]
    assert got == [(r.s, r.x, r.id) for r in rows.orderBy(*order).collect()]
    assert sorted(r.rank for r in global_rank(rows, order, write, "again").collect()) == list(range(1, 5_001))
    assert global_rank(rows.limit(0), order, write, "none").count() == 0
