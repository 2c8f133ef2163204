"""The reference's end-to-end flow on files: a bucket of racing CSVs becomes
raw tables, then the warehouse (facts + views), then an export that is
imported back into a fresh catalog."""

import itertools
import os
import threading
import uuid

import pytest

from gridlake.plans import catalog, racing, reports, roundtrips
from gridlake.plans.results import fetch
from gridlake.sources import export, files, listing

SF001 = "/root/testdata/sf0.001"
N = "\\N"
FILES = {
    "results.csv": (
        "resultId,raceId,driverId,constructorId,statusId,grid,position,positionText,positionOrder,points,laps,"
        "time,milliseconds,fastestLap,rank,fastestLapTime,fastestLapSpeed\n"
        f"1,10,1,1,1,1,1,1,1,25,57,1:34:50.616,5690616,40,1,1:20.5,210.1\n"
        f"2,10,2,2,1,6,2,2,2,18,57,+5.978,5696594,41,{N},1:21.0,209.0\n"
        f"3,11,2,2,1,8,1,1,1,25,63,{N},,42,2,1:19.9,211.3\n"
    ),
    "sprint_results.csv": (
        "resultId,raceId,driverId,constructorId,statusId,grid,position,positionText,positionOrder,points,laps,"
        "time,milliseconds,fastestLap,fastestLapTime\n"
        "9,10,1,1,1,2,1,1,1,8,19,30:01,5,10,1:22.0\n"
    ),
    "races.csv": "raceId,year,name\n10,2021,Bahrain Grand Prix\n11,2024,Monaco Grand Prix\n",
    "drivers.csv": "driverId,forename,surname\n1,Max,Verstappen\n2,Lewis,Hamilton\n",
    "constructors.csv": "constructorId,name\n1,Red Bull\n2,Mercedes\n",
    "status.csv": "statusId,status\n1,Finished\n",
    "qualifying.csv": "qualifyId,raceId,driverId,constructorId,position,q1,q2,q3\n1,10,1,1,1,1:30,1:29,1:28\n2,11,2,2,1,1:40,1:39,\\N\n",
}


def test_bucket_to_warehouse_to_export(spark, tmp):
    bucket = os.path.join(tmp, "raw-dataset")
    for name, text in FILES.items():
        os.makedirs(f"{bucket}/f1", exist_ok=True)
        with open(f"{bucket}/f1/{name}", "w") as f:
            f.write(text)
    assert listing.prefix_exists(spark, bucket, "f1/")
    made = files.bucket_to_tables(spark, bucket, database="wf_raw", prefix="f1/")
    assert len(made) == 7
    t = racing.from_tables(spark, "wf_raw")
    # the sample join of the reference's main script
    sample = fetch(reports.race_driver_sample(t), None)
    assert [tuple(r) for r in sample] == [
        ("Bahrain Grand Prix 2021", "Lewis Hamilton"),
        ("Bahrain Grand Prix 2021", "Max Verstappen"),
        ("Monaco Grand Prix 2024", "Lewis Hamilton"),
    ]
    catalog.build_warehouse(spark, t, raw_db="wf_raw2", derived_db="wf_derived")
    pts = [tuple(r) for r in spark.table("wf_derived.driverPoints").collect()]
    assert pts == [("Lewis Hamilton", 43.0), ("Max Verstappen", 33.0)]
    # \N rank counts as rank 20: only Max's lap is a fastest lap
    assert [tuple(r) for r in spark.table("wf_derived.fastestLapsPerDriver").collect()] == [("Max Verstappen", 1)]
    raced = {r.resultId: r.raced_time for r in spark.table("wf_derived.resultFacts").collect()}
    assert raced[1] == "1:34:50.616.5690616" and raced[3] is None
    # export both schemas, drop them, import, and the views answer again
    out = os.path.join(tmp, "export")
    export.export_database(spark, out, ["wf_raw2", "wf_derived"], "parquet")
    spark.sql("DROP DATABASE wf_derived CASCADE")
    spark.sql("DROP DATABASE wf_raw2 CASCADE")
    export.import_database(spark, out)
    assert [tuple(r) for r in spark.table("wf_derived.driverPoints").collect()] == pts
    assert spark.table("wf_derived.mostPolesPerDriver").count() == 2


def _several_at_once(fn):
    """``fn``, whose first two calls wait for each other."""
    both, calls = threading.Barrier(2, timeout=20), itertools.count()

    def run(*a, **k):
        if next(calls) < 2:
            both.wait()
        return fn(*a, **k)

    return run


def test_tables_load_side_by_side(spark, tmp, monkeypatch):
    rows = {name: [(i, f"{name}{i}") for i in range(20)] for name in ("one", "three", "two")}
    for name, some in rows.items():
        files.write(spark.createDataFrame(some, "id int, name string"), f"{tmp}/{name}.csv", "csv")
    monkeypatch.setattr(files, "scan", _several_at_once(files.scan))
    db = f"side_{uuid.uuid4().hex}"
    assert files.bucket_to_tables(spark, tmp, database=db) == [f"{db}.{name}" for name in rows]  # in the order of their names
    assert {name: sorted(map(tuple, spark.table(f"{db}.{name}").collect())) for name in rows} == rows
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_a_table_that_fails_to_load_is_an_error(spark, tmp):
    files.write(spark.range(3), f"{tmp}/good.parquet")
    os.makedirs(f"{tmp}/bad.parquet")
    with open(f"{tmp}/bad.parquet/x.parquet", "w") as f:
        f.write("no parquet")
    db = f"fails_{uuid.uuid4().hex}"
    with pytest.raises(Exception, match="x.parquet"):
        files.bucket_to_tables(spark, tmp, database=db)
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_convert_then_load_writes_side_by_side(spark, monkeypatch):
    want = [tuple(r) for r in reports.race_driver_sample(racing.from_tpch(spark, SF001)).collect()]
    monkeypatch.setattr(files, "write", _several_at_once(files.write))
    assert [tuple(r) for r in roundtrips.convert_then_load(spark, SF001).collect()] == want
