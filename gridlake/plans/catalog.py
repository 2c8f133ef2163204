"""The warehouse in the session catalog.

``build_warehouse`` does what the reference's SQL script does, as Spark
catalog objects: two schemas, the raw tables, the two fact tables written
once (CTAS), and the report views stored as SQL over them. The fact table
of results is partitioned by ``race_type``, so the views that keep only
normal races read one partition: the saved table keeps the pruning the
unmaterialised union gets from its literal column.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from gridlake.plans.facts import quali_facts, result_facts
from gridlake.plans.racing import RacingTables, from_tables
from gridlake.plans.reports import REPORTS

# The reference's schema names.
RAW_DB = "raw_data"
DERIVED_DB = "derived_data"

def reset_schemas(spark: SparkSession, names: tuple[str, ...] = (RAW_DB, DERIVED_DB)) -> None:
    """C4: drop and re-create the schemas."""
    for n in names:
        spark.sql(f"DROP DATABASE IF EXISTS {n} CASCADE")
        spark.sql(f"CREATE DATABASE {n}")


def save_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> str:
    """``DROP TABLE IF EXISTS`` + ``CREATE TABLE AS``."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return name


def save_raw(tables: RacingTables, db: str = RAW_DB) -> list[str]:
    return [save_table(df, f"{db}.{name}") for name, df in tables.as_dict().items()]


def build_facts(tables: RacingTables, db: str = DERIVED_DB) -> tuple[str, str]:
    """Q1/Q2 written once as tables, as the reference's CTAS statements do.

    The two writes are independent, so they run as concurrent Spark jobs:
    while one has a narrow stage, the other keeps the executors busy.
    """
    with ThreadPoolExecutor(max_workers=2) as pool:
        r = pool.submit(save_table, result_facts(tables), f"{db}.resultFacts", ("race_type",))
        q = pool.submit(save_table, quali_facts(tables), f"{db}.qualiFacts")
        return r.result(), q.result()


def create_views(spark: SparkSession, db: str = DERIVED_DB) -> list[str]:
    """``CREATE OR REPLACE VIEW`` for every report, from the one definition each has."""
    made = []
    for name, report in REPORTS.items():
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} AS {report.sql(db)}")
        made.append(f"{db}.{name}")
    return made


def build_derived(spark: SparkSession, raw_db: str = RAW_DB, derived_db: str = DERIVED_DB) -> list[str]:
    """The derived schema, its fact tables and views, from raw tables that the
    catalog has; only the derived schema is dropped and made anew."""
    if raw_db.lower() == derived_db.lower():
        raise ValueError("the derived schema is dropped first, so it can't be the raw one")
    reset_schemas(spark, (derived_db,))
    made = list(build_facts(from_tables(spark, raw_db), derived_db)) + create_views(spark, derived_db)
    spark.catalog.setCurrentDatabase(derived_db)
    return made


def _reads(df: DataFrame, db: str) -> bool:
    """Whether a frame reads a catalog table of the schema."""
    plan = df._jdf.queryExecution().analyzed().toString().lower()
    return f"spark_catalog.{db.lower()}." in plan


def build_warehouse(
    spark: SparkSession,
    tables: RacingTables,
    raw_db: str = RAW_DB,
    derived_db: str = DERIVED_DB,
    keep_raw: bool = True,
) -> list[str]:
    """Schemas, raw tables, fact tables and views, in the reference's order.

    A schema that the given tables are read from is never dropped: if that is
    ``raw_db`` its tables are used as they are.
    """
    frames = tables.as_dict().values()
    if any(_reads(df, derived_db) for df in frames):
        raise ValueError(f"the inputs are read from {derived_db}, which would be dropped")
    if any(_reads(df, raw_db) for df in frames):
        return build_derived(spark, raw_db, derived_db)
    made = []
    if keep_raw:
        reset_schemas(spark, (raw_db,))
        made = save_raw(tables, raw_db)
        return made + build_derived(spark, raw_db, derived_db)
    reset_schemas(spark, (derived_db,))
    made += list(build_facts(tables, derived_db))
    made += create_views(spark, derived_db)
    spark.catalog.setCurrentDatabase(derived_db)
    return made
