import datetime as dt
import glob
import os
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridlake.sources import files

SCHEMA = "i int, l long, d double, s string, b binary, t timestamp, n timestamp_ntz, x decimal(20, 3), a array<int>, m struct<p:int,q:string>, f date, o boolean"
AT = dt.datetime(2024, 2, 29, 12, 30, 1, 123456)
ROWS = [
    (1, 2**60, 1.5, "é\n", b"\x00\xff", AT, AT, Decimal("12345678901234567.123"), [1, None], (1, None), dt.date(2024, 1, 1), True),
    (None,) * 12,
    (-1, 0, float("-inf"), "", b"", AT, AT, Decimal("-0.001"), [], (None, "z"), dt.date(1900, 1, 1), False),
]


def test_types_survive(spark, tmp):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    files.write(df, f"{tmp}/t.arrow", "arrow")
    back = files.scan(spark, f"{tmp}/t.arrow")
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(back.collect(), key=repr) == sorted(df.collect(), key=repr)
    named = files.scan(spark, f"{tmp}/t.arrow", schema="s string, i int")
    assert sorted(named.collect(), key=repr) == sorted(df.select("s", "i").collect(), key=repr)
    for f in glob.glob(f"{tmp}/t.arrow/*.arrow"):
        with pa.OSFile(f) as x:  # any reader of the format can read them
            assert pa.ipc.open_file(x).read_all().num_columns == 12
    assert files.query_file(spark, f"{tmp}/t.arrow").count() == 3


def test_overwrite_append_and_empty(spark, tmp):
    path = f"{tmp}/t.arrow"
    files.write(spark.range(10), path, "arrow")
    files.write(spark.range(5), path, "arrow", mode="append")
    assert files.scan(spark, path).count() == 15
    files.write(spark.range(3), path, "arrow")
    assert files.scan(spark, path).count() == 3 and os.path.exists(f"{path}/_SUCCESS") and not os.path.exists(f"{path}/_temporary")
    files.write(spark.range(0), path, "arrow")
    assert files.scan(spark, path).columns == ["id"] and files.scan(spark, path).count() == 0


def test_a_failed_write_leaves_the_folder_as_it_was(spark, tmp):
    path = f"{tmp}/t.arrow"
    files.write(spark.range(10), path, "arrow")
    before = set(os.listdir(path))
    bad = spark.range(1000).repartition(4).select(F.when(F.col("id") == 777, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        files.write(bad, path, "arrow")
    assert set(os.listdir(path)) == before and files.scan(spark, path).count() == 10


def test_tables_of_many_batches(spark, tmp):
    files.write(spark.range(100_000).withColumn("s", F.md5(F.col("id").cast("string"))), f"{tmp}/t.arrow", "arrow")
    back = files.scan(spark, f"{tmp}/t.arrow")
    assert back.agg(F.sum("id"), F.count_distinct("s")).first()[:] == (100_000 * 99_999 // 2, 100_000)
    with pytest.raises(Exception, match="no .arrow files"):
        files.scan(spark, f"{tmp}/missing.arrow").count()
