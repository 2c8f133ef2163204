from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridlake.plans import catalog, facts, racing, reports
from gridlake.plans.results import fetch

SF001 = "/root/testdata/sf0.001"

RES = (
    "resultId bigint, raceId bigint, driverId bigint, constructorId bigint, statusId bigint, grid bigint, "
    "position string, positionText string, positionOrder bigint, points double, laps bigint, time string, "
    "milliseconds string, fastestLap string, rank string, fastestLapTime string, fastestLapSpeed string"
)
SPRINT = ", ".join(c for c in RES.split(", ") if not c.startswith(("rank ", "fastestLapSpeed ")))
N = "\\N"


def _res(rid, race, drv, grid, finish, points, rank="5", ms="123", cons=1):
    return (rid, race, drv, cons, 1, grid, str(finish), str(finish), finish, points, 50, "1:30", ms, "40", rank, "1:20.5", "210.1")


@pytest.fixture()
def f1(spark):
    results = [
        _res(1, 10, 1, 1, 1, 25.0, rank="1"),          # pole win, fastest lap
        _res(2, 10, 2, 6, 2, 18.0, rank=N),            # \N rank -> 20
        _res(3, 11, 1, 1, 1, 25.0, rank="20"),         # same driver wins from same slot again
        _res(4, 11, 3, 7, 2, 0.5, ms=None),            # NULL milliseconds; gain 5 with points < 1
        _res(5, 12, 2, 6, 1, 1.0, rank=None),          # gain 5 win with points 1; NULL rank
        _res(6, 12, 4, 5, 1, 0.0),                     # gain 4 (not far back); NULL surname driver
        _res(7, 13, 99, 1, 1, 25.0),                   # orphan driver: drops
        _res(8, 13, 3, 2, 3, 15.0, rank="1", cons=2),  # negative gain, fastest lap
        _res(8, 13, 3, 2, 3, 15.0, rank="1", cons=2),  # exact duplicate: UNION removes it
    ]
    sprint = [tuple(v for i, v in enumerate(_res(20, 10, 2, 1, 1, 8.0)) if i not in (14, 16))]
    quali = [(1, 10, 1, 1, 1, "1:10", "1:09", "1:08"), (2, 10, 2, 1, 2, "1:11", N, N), (3, 11, 1, 1, 1, "1:10", "1:09", "1:07")]
    t = racing.RacingTables(
        results=spark.createDataFrame(results, RES),
        sprint_results=spark.createDataFrame(sprint, SPRINT),
        qualifying=spark.createDataFrame(quali, "qualifyId bigint, raceId bigint, driverId bigint, constructorId bigint, position bigint, q1 string, q2 string, q3 string"),
        races=spark.createDataFrame([(10, 2021, "Bahrain"), (11, 2021, "Imola"), (12, 2024, "Monaco"), (13, 2024, "Spa")], "raceId bigint, year bigint, name string"),
        drivers=spark.createDataFrame([(1, "Max", "V"), (2, "Lewis", "H"), (3, "Lando", "N"), (4, "Nico", None)], "driverId bigint, forename string, surname string"),
        constructors=spark.createDataFrame([(1, "Red Bull"), (2, "McLaren")], "constructorId bigint, name string"),
        status=spark.createDataFrame([(1, "Finished")], "statusId bigint, status string"),
    )
    return t


def _pairs(df):
    return [tuple(r) for r in df.collect()]


def test_result_facts_semantics(f1):
    rf = facts.result_facts(f1)
    rows = rf.collect()
    assert len(rows) == 8  # 9 results - orphan - duplicate + 1 sprint
    by_id = {(r.resultId, r.race_type): r for r in rows}
    assert by_id[(1, "Normal race")].race_name == "Bahrain 2021"
    assert by_id[(1, "Normal race")].driver_name == "Max V"
    assert by_id[(4, "Normal race")].raced_time is None
    assert by_id[(1, "Normal race")].raced_time == "1:30.123"
    assert by_id[(6, "Normal race")].driver_name is None
    sprint = by_id[(20, "Sprint race")]
    assert sprint.rank is None and sprint.fastestLapSpeed_kmph is None
    assert list(rf.columns) == list(facts.RESULT_FACT_COLUMNS)


def test_reports_on_edge_rows(f1):
    rf = facts.result_facts(f1)
    qf = facts.quali_facts(f1)
    assert _pairs(reports.driver_points(rf)) == [("Max V", 50.0), ("Lewis H", 27.0), ("Lando N", 15.5), (None, 0.0)]
    assert _pairs(reports.fastest_laps_per_driver(rf)) == [("Lando N", 1), ("Max V", 1)]
    assert _pairs(reports.fastest_laps_per_constructor(rf)) == [("McLaren", 1), ("Red Bull", 1)]
    assert [r.race_name for r in reports.fastest_laps_per_race(rf).collect()] == ["Bahrain 2021", "Spa 2024"]
    # the sprint win from pole counts here ...
    assert _pairs(reports.most_wins_from_pole(rf)) == [("Max V", 2), ("Lewis H", 1)]
    # ... but not without sprints
    assert _pairs(reports.most_wins_per_driver_without_sprint(rf)) == [("Max V", 2), ("Lewis H", 1), (None, 1)]
    assert _pairs(reports.most_wins_per_constructor_without_sprint(rf)) == [("Red Bull", 4)]
    assert _pairs(reports.most_wins_from_far_back(rf)) == [("Lewis H", 1)]
    assert _pairs(reports.most_positions_gained_by_driver(rf)) == [("Lewis H", 1)]
    assert _pairs(reports.most_wins_from_different_positions(rf)) == [("Lewis H", 2), ("Max V", 1), (None, 1)]
    far = _pairs(reports.drivers_win_from_far_back(rf))
    assert far[0] == ("Lewis H", "Monaco 2024", 6, 5) and far[1][3] == 4
    assert _pairs(reports.most_poles_per_driver(qf)) == [("Max V", 2)]
    assert _pairs(reports.most_poles_per_constructor(qf)) == [("Red Bull", 2)]


def test_year_filter_compares_strings(f1, spark):
    rf = facts.result_facts(f1)
    assert _pairs(reports.driver_points(rf, year=2024)) == [("Lando N", 15.0), ("Lewis H", 1.0), (None, 0.0)]
    odd = rf.withColumn("race_name", F.lit("no year here"))
    assert reports.driver_points(odd, year=2024).count() == 0


def test_sample_and_fetch(f1):
    s = reports.race_driver_sample(f1, n=3)
    assert _pairs(s) == [("Bahrain 2021", "Lewis H"), ("Bahrain 2021", "Max V"), ("Imola 2021", "Lando N")]
    assert fetch(s, 1) == s.first()
    assert len(fetch(s, 2)) == 2 and len(fetch(s, None)) == 3


def test_warehouse_views_match_reports(spark):
    t = racing.from_tpch(spark, SF001)
    catalog.build_warehouse(spark, t, raw_db="t_raw", derived_db="t_derived")
    rf = spark.table("t_derived.resultFacts")
    qf = spark.table("t_derived.qualiFacts")
    for name, fn in reports.RESULT_VIEWS.items():
        assert Counter(_pairs(spark.table(f"t_derived.{name}"))) == Counter(_pairs(fn(rf))), name
    for name, fn in reports.QUALI_VIEWS.items():
        assert Counter(_pairs(spark.table(f"t_derived.{name}"))) == Counter(_pairs(fn(qf))), name
    # the saved fact table is partitioned by race type, so normal-race views prune
    plan = spark.table("t_derived.mostWinsPerDriverWithoutSprint")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(race_type" in plan
    # and the saved facts equal the lazily built ones
    assert rf.count() == facts.result_facts(t).count()


def test_points_are_summed_exactly(spark):
    rows = [("A", 0.004)] * 1000 + [("B", 0.1)] * 10 + [("B", None)] + [("C", 1e-9)]
    facts = spark.createDataFrame(rows, "driver_name string, points double")
    assert [tuple(r) for r in reports.driver_points(facts).collect()] == [("A", 4.0), ("B", 1.0), ("C", 1e-9)]


def test_views_and_frames_agree(spark):
    """Every report has one definition; its view over saved facts gives the frame's rows in the same order."""
    from gridlake.plans import catalog, racing

    t = racing.from_tpch(spark, SF001)
    catalog.build_warehouse(spark, t, "agree_raw", "agree_derived")
    for name, report in reports.REPORTS.items():
        want = report.frame(spark.table(f"agree_derived.{report.source}")).collect()
        assert spark.table(f"agree_derived.{name}").collect() == want and (want or name)
    spark.catalog.setCurrentDatabase("default")


def test_the_warehouse_keeps_what_it_reads(spark):
    from gridlake.__main__ import main
    from gridlake.plans import catalog, racing

    t = racing.from_tpch(spark, SF001)
    catalog.reset_schemas(spark, ("keep_raw",))
    catalog.save_raw(t, "keep_raw")
    before = {x.name: spark.table(f"keep_raw.{x.name}").count() for x in spark.catalog.listTables("keep_raw") if not x.isTemporary}
    assert main(["warehouse", "--raw-db", "keep_raw", "--derived-db", "keep_derived"]) == 0
    catalog.build_warehouse(spark, racing.from_tables(spark, "keep_raw"), "keep_raw", "keep_derived")
    assert {x.name: spark.table(f"keep_raw.{x.name}").count() for x in spark.catalog.listTables("keep_raw") if not x.isTemporary} == before
    assert len(before) == 7 and spark.table("keep_derived.driverPoints").count() > 0
    for other in ("keep_raw", "keep_derived"):
        with pytest.raises(ValueError):
            catalog.build_derived(spark, other, other)
    spark.catalog.setCurrentDatabase("default")
