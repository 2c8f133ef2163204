r"""The racing warehouse's raw tables.

The reports run on seven raw tables (results, sprint_results, qualifying,
races, drivers, constructors, status). They come either from files with the
reference's column names (``from_tables`` after loading them into the
catalog, or ``from_frames``), or, for tests and the bench, from
the driver's TPC-H-style tables (``from_tpch``) with this mapping:

=================  ==========================================================
results            lineitem rows with l_returnflag 'N'
sprint_results     lineitem rows with l_returnflag 'R'
qualifying         lineitem rows with l_returnflag 'A'
races              orders: name = o_orderpriority, year = year(o_orderdate)
drivers            customer: forename = c_mktsegment, surname = c_name
constructors       supplier: name = s_name
status             part: status = p_type
=================  ==========================================================

Columns of the three results-shaped tables (``ln`` = ``l_linenumber``):

==================  ===========================================================
resultId            l_orderkey * 10 + ln (not unique, like any derived id here)
raceId / driverId   l_orderkey / o_custkey of that order
constructorId       l_suppkey;  statusId: l_partkey
grid                l_quantity % 20 + 1
position            ln as text, ``\N`` for line 7;  positionText: l_linestatus
positionOrder       ln
points              l_quantity / 2 (so Q11's ``points >= 1`` is a real filter)
laps                l_partkey
time, milliseconds  l_tax and l_discount in hundredths, as text; milliseconds
                    is NULL on open lines, so ``time||'.'||milliseconds`` meets NULLs
fastestLap          l_suppkey as text
rank                l_partkey % 20 + 1 as text, ``\N`` for line 7 (independent
                    of the finishing order, so fastest laps are not just wins)
fastestLapTime      l_extendedprice as decimal(12,2) text (qualifying q1 too)
fastestLapSpeed     l_partkey as text
q2 / q3             text, ``\N`` below line 5 / 3
==================  ===========================================================

The lineitem -> orders join that gives each result its driver (o_custkey) is
the one big-to-big join of the mapping; it hash-partitions the results by
order key, which the later races join on the same key reuses.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.functions.predicates import MISSING_MARKER

RAW_TABLES = (
    "results",
    "sprint_results",
    "qualifying",
    "races",
    "drivers",
    "constructors",
    "status",
)


@dataclass
class RacingTables:
    results: DataFrame
    sprint_results: DataFrame
    qualifying: DataFrame
    races: DataFrame
    drivers: DataFrame
    constructors: DataFrame
    status: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in RAW_TABLES}


def read_tpch(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _digits(c) -> F.Column:
    """Two-decimal fraction as a whole number of hundredths, as a string."""
    return F.round(c * F.lit(100)).cast("bigint").cast("string")


def _money(c) -> F.Column:
    return c.cast("decimal(12,2)").cast("string")


def _marker_unless(cond, value) -> F.Column:
    return F.when(cond, value).otherwise(F.lit(MISSING_MARKER))


def from_tpch(spark: SparkSession, sf_dir: str) -> RacingTables:
    li = read_tpch(spark, sf_dir, "lineitem")
    orders = read_tpch(spark, sf_dir, "orders")
    order_driver = orders.select(
        F.col("o_orderkey").alias("raceId"), F.col("o_custkey").alias("driverId")
    )

    def entries(flag: str) -> DataFrame:
        # Filter first so only this flag's rows reach the scan and the shuffle.
        base = li.where(F.col("l_returnflag") == F.lit(flag)).withColumnRenamed(
            "l_orderkey", "raceId"
        )
        return base.join(order_driver, on="raceId", how="inner")

    ln = F.col("l_linenumber")
    qty = F.col("l_quantity")
    result_cols = {
        "resultId": (F.col("raceId") * F.lit(10) + ln).cast("bigint"),
        "raceId": F.col("raceId"),
        "driverId": F.col("driverId"),
        "constructorId": F.col("l_suppkey"),
        "statusId": F.col("l_partkey"),
        "grid": qty.cast("bigint") % F.lit(20) + F.lit(1),
        "position": _marker_unless(ln != F.lit(7), ln.cast("string")),
        "positionText": F.col("l_linestatus"),
        "positionOrder": ln.cast("bigint"),
        "points": qty / F.lit(2),
        "laps": F.col("l_partkey"),
        "time": _digits(F.col("l_tax")),
        "milliseconds": F.when(F.col("l_linestatus") == F.lit("F"), _digits(F.col("l_discount"))),
        "fastestLap": F.col("l_suppkey").cast("string"),
        "rank": _marker_unless(ln != F.lit(7), (F.col("l_partkey") % F.lit(20) + F.lit(1)).cast("string")),
        "fastestLapTime": _money(F.col("l_extendedprice")),
        "fastestLapSpeed": F.col("l_partkey").cast("string"),
    }
    results = entries("N").select(*[c.alias(n) for n, c in result_cols.items()])
    # Sprint results have no rank and no fastest-lap speed.
    sprint_results = entries("R").select(
        *[c.alias(n) for n, c in result_cols.items() if n not in ("rank", "fastestLapSpeed")]
    )
    qualifying = entries("A").select(
        (F.col("raceId") * F.lit(10) + ln).cast("bigint").alias("qualifyId"),
        F.col("raceId"),
        F.col("driverId"),
        F.col("l_suppkey").alias("constructorId"),
        ln.cast("bigint").alias("position"),
        _money(F.col("l_extendedprice")).alias("q1"),
        _marker_unless(ln <= F.lit(5), F.col("l_partkey").cast("string")).alias("q2"),
        _marker_unless(ln <= F.lit(3), F.col("l_suppkey").cast("string")).alias("q3"),
    )
    races = orders.select(
        F.col("o_orderkey").alias("raceId"),
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.col("o_orderpriority").alias("name"),
    )
    drivers = read_tpch(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("driverId"),
        F.col("c_mktsegment").alias("forename"),
        F.col("c_name").alias("surname"),
    )
    constructors = read_tpch(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("constructorId"), F.col("s_name").alias("name")
    )
    status = read_tpch(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("statusId"), F.col("p_type").alias("status")
    )
    return RacingTables(results, sprint_results, qualifying, races, drivers, constructors, status)


def from_tables(spark: SparkSession, database: str | None = None) -> RacingTables:
    """Raw tables already in the catalog (e.g. loaded by ``bucket_to_tables``)."""
    prefix = f"{database}." if database else ""
    return RacingTables(*[spark.table(prefix + n) for n in RAW_TABLES])


def from_frames(frames: dict[str, DataFrame]) -> RacingTables:
    return RacingTables(*[frames[n] for n in RAW_TABLES])
