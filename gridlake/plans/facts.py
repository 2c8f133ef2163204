"""The two fact tables: ``resultFacts`` (Q1) and ``qualiFacts`` (Q2).

Both are star joins of a results-shaped table with its dimensions. The
dimension-side expressions (``race_name``, ``driver_name``) are computed
before the join, so each dimension ships one narrow row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.predicates import NORMAL_RACE, SPRINT_RACE
from gridlake.functions.strings import concat_sql, null_of, spaced
from gridlake.operators.joins import Dim, star_join
from gridlake.operators.partitions import distinct_by_size
from gridlake.plans.racing import RacingTables

RESULT_FACT_COLUMNS = (
    "resultId",
    "raceId",
    "race_type",
    "race_name",
    "driver_name",
    "constructor_name",
    "starting_grid",
    "position",
    "finishPosition",
    "finishOrder",
    "points",
    "laps",
    "raced_time",
    "fastestLap",
    "rank",
    "fastestLapTime",
    "fastestLapSpeed_kmph",
    "status",
)

QUALI_FACT_COLUMNS = (
    "qualifyId",
    "raceId",
    "race_name",
    "driver_name",
    "constructor_name",
    "finalQualiPosition",
    "q1Time",
    "q2Time",
    "q3Time",
)


def race_dim(t: RacingTables) -> Dim:
    return Dim(t.races.select("raceId", spaced("name", "year").alias("race_name")), "raceId")


def driver_dim(t: RacingTables) -> Dim:
    return Dim(t.drivers.select("driverId", spaced("forename", "surname").alias("driver_name")), "driverId")


def constructor_dim(t: RacingTables) -> Dim:
    return Dim(t.constructors.select("constructorId", F.col("name").alias("constructor_name")), "constructorId")


def status_dim(t: RacingTables) -> Dim:
    return Dim(t.status.select("statusId", "status"), "statusId")


# Result columns the data model types as text. Inferred types of raw files
# can differ between the two results tables (a column of lap times may be
# read as timestamps in one file and as text in the other); the union of the
# two is text, as in SQL.
TEXT_COLUMNS = ("position", "positionText", "time", "milliseconds", "fastestLap", "rank", "fastestLapTime", "fastestLapSpeed")


def _tagged_results(entries: DataFrame, race_type: str, sprint: bool) -> DataFrame:
    """One results table with its race type; sprints get NULL rank and speed."""
    cols = [
        "resultId", "raceId", "driverId", "constructorId", "statusId", "grid", "position",
        "positionText", "positionOrder", "points", "laps", "time", "milliseconds", "fastestLap",
        "rank", "fastestLapTime", "fastestLapSpeed",
    ]
    out = []
    for c in cols:
        if sprint and c in ("rank", "fastestLapSpeed"):
            out.append(null_of("string").alias(c))
        elif c in TEXT_COLUMNS:
            out.append(F.col(c).cast("string").alias(c))
        else:
            out.append(F.col(c))
    return entries.select(*out, F.lit(race_type).alias("race_type"))


def result_facts(t: RacingTables) -> DataFrame:
    """Q1: normal and sprint results, star-joined, ``UNION`` (distinct).

    Rows of the two results tables differ in their literal ``race_type``, so
    the distinct over the 18 output columns is taken of each by itself, and
    its tasks, which hold whole rows, are as many as the size of its input
    asks for. The dimensions' shuffles and broadcasts are the same in both
    star joins, so Spark makes them once. A ``race_type`` filter above this
    plan still prunes the other table (Catalyst folds the literal).
    """
    normal = _tagged_results(t.results, NORMAL_RACE, sprint=False)
    sprint = _tagged_results(t.sprint_results, SPRINT_RACE, sprint=True)
    return _result_rows(normal, t).unionByName(_result_rows(sprint, t))


def _result_rows(entries: DataFrame, t: RacingTables) -> DataFrame:
    """The distinct fact rows of one results table."""
    # races first: it joins on the key the results are already partitioned and sorted by.
    joined = star_join(entries, [race_dim(t), status_dim(t), driver_dim(t), constructor_dim(t)])
    rows = joined.select(
        F.col("resultId"),
        F.col("raceId"),
        F.col("race_type"),
        F.col("race_name"),
        F.col("driver_name"),
        F.col("constructor_name"),
        F.col("grid").alias("starting_grid"),
        F.col("position"),
        F.col("positionText").alias("finishPosition"),
        F.col("positionOrder").alias("finishOrder"),
        F.col("points"),
        F.col("laps"),
        concat_sql("time", F.lit("."), "milliseconds").alias("raced_time"),
        F.col("fastestLap"),
        F.col("rank"),
        F.col("fastestLapTime"),
        F.col("fastestLapSpeed").alias("fastestLapSpeed_kmph"),
        F.col("status"),
    )
    # Not by the columns that are literals of a table: Spark folds them, and would deal the rows once more.
    return distinct_by_size(rows, [c for c in RESULT_FACT_COLUMNS if c not in ("race_type", "rank", "fastestLapSpeed_kmph")])


def quali_facts(t: RacingTables) -> DataFrame:
    """Q2: qualifying star-joined with races, drivers and constructors."""
    joined = star_join(t.qualifying, [race_dim(t), driver_dim(t), constructor_dim(t)])
    return joined.select(
        F.col("qualifyId"),
        F.col("raceId"),
        F.col("race_name"),
        F.col("driver_name"),
        F.col("constructor_name"),
        F.col("position").alias("finalQualiPosition"),
        F.col("q1").alias("q1Time"),
        F.col("q2").alias("q2Time"),
        F.col("q3").alias("q3Time"),
    )


def race_driver_pairs(t: RacingTables) -> DataFrame:
    """Results joined with races and drivers, two name columns."""
    joined = star_join(t.results, [race_dim(t), driver_dim(t)])
    return joined.select("race_name", "driver_name")


def race_driver_union(t: RacingTables) -> DataFrame:
    """U1 on a narrow projection: every (race, driver) pair with a normal or
    sprint result, each once.

    The names are a function of (raceId, driverId), so the distinct id
    pairs of both tables are taken first (combined map-side) and only they
    are joined; the final distinct is over the names, as the SQL asks.
    """
    ids = t.results.select("raceId", "driverId").union(t.sprint_results.select("raceId", "driverId")).distinct()
    joined = star_join(ids, [race_dim(t), driver_dim(t)])
    return joined.select("race_name", "driver_name").distinct()

