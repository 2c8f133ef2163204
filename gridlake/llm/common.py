"""What the operators share: reading a table, tables written for a next step, hash folds."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.session import scratch_path

# Rows that go to a Python worker at once. Texts may be long, so fewer than
# Spark's default of 10,000; the operators cut a batch further by bytes.
ARROW_ROWS = 1000


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the session's workers, which may not have it installed, in small Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "gridlake.zip")  # read by this driver alone, which serves it
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, in a session whose workers have this package."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string) of documents, whatever other columns they have."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


class Stage:
    """Tables written in the shared checkpoint folder so that later jobs read
    them instead of computing them again. They survive lost executors.

    ``drop`` deletes what is no longer read; a table behind a returned frame
    stays until the folder's owner clears it.
    """

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.base = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
        self.paths: dict[str, str] = {}
        self.tables: dict[str, str] = {}
        self.n = 0

    def write(self, df: DataFrame, name: str, key: str | None = None) -> DataFrame:
        """The table written and reread. With a ``key`` its rows lie in buckets: joins on the key don't shuffle them."""
        self.n += 1
        path = f"{self.base}/{self.n:03d}-{name}"
        self.paths[name] = path
        if key is None:
            df.write.parquet(path)
        else:
            n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            self.tables[name] = f"{re.sub('[^a-z0-9]', '_', name.lower())}_{uuid.uuid4().hex}"
            df.repartition(n, key).write.format("parquet").bucketBy(n, key).option("path", path).saveAsTable(self.tables[name])
        # Shuffle files go when the driver's garbage collector meets their plans, which may be long after.
        gc.collect()
        self.spark._jvm.System.gc()
        return self.spark.table(self.tables[name]) if key else self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, sc = self.spark._jvm, self.spark.sparkContext
        for name in names:
            if name in self.tables:
                self.spark.sql(f"DROP TABLE {self.tables.pop(name)}")  # its files stay
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: Column) -> Column:
    """The fold that learns nothing: crc32 of the id as text, mod 5, is 0."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def unit_hash(col: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the value and the seed only."""
    return F.pmod(F.xxhash64(col, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
