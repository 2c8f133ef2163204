"""Row predicates of the report queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results.
MISSING_MARKER = "\\N"      # the two-character CSV null marker, backslash + N
MISSING_RANK_AS = "20"      # a missing rank is read as rank 20
NORMAL_RACE = "Normal race"
SPRINT_RACE = "Sprint race"


def fastest_lap(rank: Column | str = "rank") -> Column:
    """``CASE WHEN rank = '\\N' THEN '20' ELSE rank END = '1'``.

    A NULL rank (sprint rows) yields NULL, which ``where`` treats as false.
    """
    r = F.col(rank) if isinstance(rank, str) else rank
    return F.when(r == F.lit(MISSING_MARKER), F.lit(MISSING_RANK_AS)).otherwise(r) == F.lit("1")


def is_normal_race(col: str = "race_type") -> Column:
    return F.col(col) == F.lit(NORMAL_RACE)


def race_year_is(year: int | str | None, race_name: str = "race_name") -> Column | None:
    """Optional per-year filter ``RIGHT(race_name, 4) = year``.

    Compared as strings: a name whose last four characters are not digits
    simply does not match instead of failing a numeric cast.
    """
    if year is None:
        return None
    return F.right(F.col(race_name), F.lit(4)) == F.lit(str(year))


def positions_gained(grid: str = "starting_grid", finish: str = "finishOrder") -> Column:
    return F.col(grid) - F.col(finish)
