"""The leaderboard reports (Q3-Q17) over the fact tables.

Each report is defined once, as a ``Report``: the fact table it reads, its
filter, its columns and its order, as SQL expressions. ``frame`` applies it to
a fact DataFrame, ``sql`` is the text of the stored view. Every report is
filter -> group -> measure -> order: the filter is pushed toward the scan (a
``race_type`` filter prunes the other union branch, or a partition of a saved
fact table), the aggregate is partial-then-final so each executor sends one
row per group and task, and the final order is over the small result.

The per-year variants take ``year``: ``RIGHT(race_name, 4) = year``, which
the reference has commented out in its views.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.functions.predicates import race_year_is
from gridlake.operators.ranking import global_rank
from gridlake.plans.facts import race_driver_pairs
from gridlake.plans.racing import RacingTables


@dataclass(frozen=True)
class Report:
    """``columns`` and ``order`` are (expression, alias) and (expression, descending)
    pairs; a report with a ``key`` groups by it. NULLs sort last both ways, as the
    reference's engine does. Order expressions beyond the reference's only rank
    what it leaves tied; they give the range partitioner distinct keys, so that
    one race or driver with very many rows isn't sorted in a single task."""

    source: str
    columns: tuple[tuple[str, str], ...]
    order: tuple[tuple[str, bool], ...]
    where: str = "true"
    key: str | None = None

    def frame(self, facts: DataFrame, year: int | None = None) -> DataFrame:
        in_year = race_year_is(year)
        rows = facts.where(self.where) if in_year is None else facts.where(self.where).where(in_year)
        order = [F.expr(e).desc_nulls_last() if down else F.expr(e).asc_nulls_last() for e, down in self.order]
        cols = [F.expr(e).alias(a) for e, a in self.columns]
        if self.key:
            return rows.groupBy(self.key).agg(*cols[1:]).orderBy(*order)
        return rows.withColumns({a: F.expr(e) for e, a in self.columns if e != a}).orderBy(*order).select(*[a for _, a in self.columns])

    def ranked(self, facts: DataFrame, write: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
        """The report's rows with their ``rank`` (from 1) in its order, ranked without a single-partition window.

        Rows that the order leaves tied are alike, so which of them gets which rank can't be seen.
        """
        rows = facts.where(self.where)
        over = [(F.expr(e), down) for e, down in self.order]
        if self.key:
            rows = rows.groupBy(self.key).agg(*[F.expr(e).alias(a) for e, a in self.columns[1:]])
        else:
            rows = rows.withColumns({a: F.expr(e) for e, a in self.columns if e != a})
        rows = rows.select(*[a for _, a in self.columns], *[c.alias(f"_o{i}") for i, (c, _) in enumerate(over)])
        order = [F.desc_nulls_last(f"_o{i}") if down else F.asc_nulls_last(f"_o{i}") for i, (_, down) in enumerate(over)]
        return global_rank(rows, order, write).select(*[a for _, a in self.columns], "rank")

    def sql(self, db: str) -> str:
        cols = ", ".join(e if e == a else f"{e} AS {a}" for e, a in self.columns)
        group = f" GROUP BY {self.key}" if self.key else ""
        order = ", ".join(f"{e} {'DESC' if down else 'ASC'} NULLS LAST" for e, down in self.order)
        return f"SELECT {cols} FROM {db}.{self.source} WHERE {self.where}{group} ORDER BY {order}"


def _ranked(key: str, measure: str, alias: str, where: str = "true", source: str = "resultFacts") -> Report:
    return Report(source, ((key, key), (measure, alias)), ((alias, True), (key, False)), where, key)


# Points are summed as decimals with 18 digits after the point: exact for any
# points that are given, and, unlike a sum of doubles, the same on any partitioning.
_POINTS = "cast(sum(cast(points AS decimal(38, 18))) AS double)"
_NORMAL = "race_type = 'Normal race'"
_FASTEST = rf"(CASE WHEN rank = '\\N' THEN '20' ELSE rank END) = '1' AND {_NORMAL}"
_WON = "finishOrder = 1"
_GAINED = "starting_grid - finishOrder"

# By the reference's view names; predicates and aliases are its own too.
REPORTS = {
    "constructorPoints": _ranked("constructor_name", _POINTS, "constructor_points"),
    "driverPoints": _ranked("driver_name", _POINTS, "driver_points"),
    "fastestLapsPerRace": Report(
        "resultFacts",
        (("race_name", "race_name"), ("driver_name", "driver_name"), ("fastestLapTime", "fastestLapTime")),
        (("raceId", False), ("driver_name", False), ("fastestLapTime", False)),
        _FASTEST,
    ),
    "fastestLapsPerDriver": _ranked("driver_name", "count(*)", "num_fastest_laps", _FASTEST),
    "fastestLapsPerConst": _ranked("constructor_name", "count(*)", "num_fastest_laps", _FASTEST),
    "mostWinsFromPole": _ranked("driver_name", "count(*)", "TimesWonFromPole", f"starting_grid = 1 AND {_WON}"),
    "driversWinFromFarBack": Report(
        "resultFacts",
        (("driver_name", "driver_name"), ("race_name", "raceName"), ("starting_grid", "startedFrom"), (_GAINED, "positionsGained")),
        (("positionsGained", True), ("driver_name", False), ("raceName", False), ("startedFrom", False)),
        _WON,
    ),
    "mostWinsFromFarBack": _ranked("driver_name", "count(*)", "winAttempts", f"{_WON} AND {_GAINED} >= 5"),
    "mostPositionsGainedByDriver": _ranked("driver_name", "count(*)", "positionsGained", f"points >= 1 AND {_GAINED} >= 5"),
    "mostWinsFromDifferentPositions": _ranked("driver_name", "count(DISTINCT starting_grid)", "gridPositions", _WON),
    "mostWinsPerDriverWithoutSprint": _ranked("driver_name", "count(*)", "winsPerDriver", f"{_WON} AND {_NORMAL}"),
    "mostWinsPerConstWithoutSprint": _ranked("constructor_name", "count(*)", "winsPerDriver", f"{_WON} AND {_NORMAL}"),
    "mostPolesPerDriver": _ranked("driver_name", "count(*)", "polesPerDriver", "finalQualiPosition = 1", "qualiFacts"),
    "mostPolesPerConst": _ranked("constructor_name", "count(*)", "polesPerDriver", "finalQualiPosition = 1", "qualiFacts"),
}

RESULT_VIEWS = {name: r.frame for name, r in REPORTS.items() if r.source == "resultFacts"}
QUALI_VIEWS = {name: r.frame for name, r in REPORTS.items() if r.source == "qualiFacts"}



def leaderboards(facts: DataFrame, source: str) -> DataFrame:
    """report, name, value: every grouped report over one fact table from one scan of it.

    A fact row becomes a row for each report whose filter it meets, with that
    report's group; one aggregate, combined in the tasks, gives all measures.
    """
    mine = {n: r for n, r in REPORTS.items() if r.key and r.source == source}
    measures = {m: f"_m{i}" for i, m in enumerate(dict.fromkeys(r.columns[1][0] for r in mine.values()))}
    each = [F.when(F.expr(r.where), F.struct(F.lit(n).alias("report"), F.col(r.key).alias("name"))) for n, r in mine.items()]
    used = [c for c in ("points", "starting_grid") if c in facts.columns]
    rows = facts.select(*used, F.explode(F.filter(F.array(*each), lambda x: x.isNotNull())).alias("_r")).select(*used, "_r.report", "_r.name")
    grouped = rows.groupBy("report", "name").agg(*[F.expr(m).alias(a) for m, a in measures.items()])
    value = None
    for n, r in mine.items():
        here, mark = F.col("report") == F.lit(n), F.col(measures[r.columns[1][0]]).cast("double")
        value = F.when(here, mark) if value is None else value.when(here, mark)
    return grouped.select("report", "name", value.alias("value"))


constructor_points = REPORTS["constructorPoints"].frame
driver_points = REPORTS["driverPoints"].frame
fastest_laps_per_race = REPORTS["fastestLapsPerRace"].frame
fastest_laps_per_driver = REPORTS["fastestLapsPerDriver"].frame
fastest_laps_per_constructor = REPORTS["fastestLapsPerConst"].frame
most_wins_from_pole = REPORTS["mostWinsFromPole"].frame
drivers_win_from_far_back = REPORTS["driversWinFromFarBack"].frame
most_wins_from_far_back = REPORTS["mostWinsFromFarBack"].frame
most_positions_gained_by_driver = REPORTS["mostPositionsGainedByDriver"].frame
most_wins_from_different_positions = REPORTS["mostWinsFromDifferentPositions"].frame
most_wins_per_driver_without_sprint = REPORTS["mostWinsPerDriverWithoutSprint"].frame
most_wins_per_constructor_without_sprint = REPORTS["mostWinsPerConstWithoutSprint"].frame
most_poles_per_driver = REPORTS["mostPolesPerDriver"].frame
most_poles_per_constructor = REPORTS["mostPolesPerConst"].frame


def race_driver_sample(t: RacingTables, n: int = 10) -> DataFrame:
    """Q17: a preview of ``n`` race/driver pairs.

    The reference takes any ``n`` rows; a fixed order makes the preview
    repeatable. Spark runs it as a per-partition top-n and a merge of
    ``n`` rows per task, never a full sort.
    """
    return (
        race_driver_pairs(t)
        .orderBy(F.asc_nulls_last("race_name"), F.asc_nulls_last("driver_name"))
        .limit(n)
    )
