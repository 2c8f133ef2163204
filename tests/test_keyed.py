import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridlake.keyed.merge import resolve
from gridlake.keyed import ops

LOG_SCHEMA = "k string, ord int, tb int, payload string, _commit_time string, _op string"


def replay(log_rows, mode):
    """Sequential model of the snapshot rules: apply commits one at a time."""
    by_commit = {}
    for r in log_rows:
        by_commit.setdefault(r["_commit_time"], []).append(r)
    table = {}

    def rank(r):
        return (r["ord"] is not None, r["ord"] if r["ord"] is not None else 0, r["tb"])

    def ordv(r):
        return (r["ord"] is not None, r["ord"] if r["ord"] is not None else 0)

    for t in sorted(by_commit):
        rows = by_commit[t]
        op = rows[0]["_op"]
        if op == "O":
            table = {}
            for r in rows:
                table.setdefault(r["k"], []).append(r)
        elif op == "I":
            for r in rows:
                table.setdefault(r["k"], []).append(r)
        elif op == "D":
            for r in rows:
                table.pop(r["k"], None)
        elif op == "U":
            best = {}
            for r in rows:
                if r["k"] not in best or rank(r) > rank(best[r["k"]]):
                    best[r["k"]] = r
            for k, r in best.items():
                cur = table.get(k, [])
                if mode == "commit" or not cur or ordv(r) >= max(ordv(c) for c in cur):
                    table[k] = [r]
    return sorted((r["payload"], r["_commit_time"], r["_op"]) for rows in table.values() for r in rows)


def random_log(seed, n_keys=12, n_commits=25):
    rnd = random.Random(seed)
    rows, pid = [], 0
    for c in range(n_commits):
        t = str(20240101000000000 + c * 1000)
        op = rnd.choices("OIUD", weights=[1, 4, 6, 3])[0]
        if op == "O" and rnd.random() < 0.2:
            continue  # an overwrite with no rows is tested on the table
        n = rnd.randint(1, 10)
        for _ in range(n):
            k = f"k{rnd.randrange(n_keys)}"
            o = None if rnd.random() < 0.15 else rnd.randint(0, 6)
            pid += 1
            rows.append(dict(k=k, ord=o, tb=rnd.randint(0, 3) * 1000 + pid, payload=f"p{pid}", _commit_time=t, _op=op))
    return rows


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("mode", ["event", "commit"])
def test_resolve_matches_sequential_replay(spark, seed, mode):
    rows = random_log(seed)
    df = spark.createDataFrame([tuple(r[c] for c in ("k", "ord", "tb", "payload", "_commit_time", "_op")) for r in rows], LOG_SCHEMA)
    got = sorted((r.payload, r._commit_time, r._op) for r in resolve(df, "k", "ord", "tb", mode).collect())
    assert got == replay(rows, mode)


def test_resolve_as_of_prefixes(spark):
    rows = random_log(42, n_commits=30)
    df = spark.createDataFrame([tuple(r[c] for c in ("k", "ord", "tb", "payload", "_commit_time", "_op")) for r in rows], LOG_SCHEMA)
    times = sorted({r["_commit_time"] for r in rows})
    for cut in (times[5], times[14], times[-1]):
        got = resolve(df.where(F.col("_commit_time") <= cut), "k", "ord", "tb", "event").collect()
        want = replay([r for r in rows if r["_commit_time"] <= cut], "event")
        assert sorted((r.payload, r._commit_time, r._op) for r in got) == want


def replay_composite(log_rows, mode):
    """The sequential model with ordering (o1, o2), each NULL lowest."""

    def okey(r):
        return tuple(x for c in ("o1", "o2") for x in (r[c] is not None, r[c] if r[c] is not None else 0))

    by_commit = {}
    for r in log_rows:
        by_commit.setdefault(r["_commit_time"], []).append(r)
    table = {}
    for t in sorted(by_commit):
        rows = by_commit[t]
        op = rows[0]["_op"]
        if op == "O":
            table = {}
        if op in ("O", "I"):
            for r in rows:
                table.setdefault(r["k"], []).append(r)
        elif op == "D":
            for r in rows:
                table.pop(r["k"], None)
        else:
            best = {}
            for r in rows:
                if r["k"] not in best or okey(r) + (r["tb"],) > okey(best[r["k"]]) + (best[r["k"]]["tb"],):
                    best[r["k"]] = r
            for k, r in best.items():
                cur = table.get(k, [])
                if mode == "commit" or not cur or okey(r) >= max(okey(c) for c in cur):
                    table[k] = [r]
    return sorted((r["payload"], r["_commit_time"], r["_op"]) for rows in table.values() for r in rows)


@pytest.mark.parametrize("seed", range(3))
def test_resolve_composite_ordering(spark, seed):
    rows = random_log(100 + seed)
    for r in rows:
        o = r["ord"]
        r["o1"] = None if o is None else o // 3
        r["o2"] = None if (o is None or o % 5 == 0) else o % 3
    cols = ("k", "o1", "o2", "tb", "payload", "_commit_time", "_op")
    df = spark.createDataFrame(
        [tuple(r[c] for c in cols) for r in rows],
        "k string, o1 int, o2 int, tb int, payload string, _commit_time string, _op string",
    )
    got = sorted((r.payload, r._commit_time, r._op) for r in resolve(df, "k", ["o1", "o2"], "tb", "event").collect())
    assert got == replay_composite(rows, "event")

RIDES = "ride_id string, started_at timestamp, station string, year int"
KEYS = dict(key="ride_id", ordering="started_at", tiebreak="station")


def _rides(spark, rows):
    data = [(k, dt.datetime.fromisoformat(t) if t else None, s) for k, t, s in rows]
    return spark.createDataFrame([(*r, r[1].year if r[1] else None) for r in data], RIDES)


def _stations(rows):
    return sorted((r.ride_id, r.station) for r in rows.collect())


@pytest.mark.parametrize("mode", ["event", "commit"])
@pytest.mark.parametrize("seed", range(2))
def test_operations_one_by_one_match_the_replay(spark, seed, mode):
    """T1-T4 applied commit after commit give what the sequential model gives."""
    log = random_log(50 + seed, n_keys=6, n_commits=8)
    schema = "k string, ord int, tb int, payload string"
    rows = spark.createDataFrame([], schema)
    by_commit = {}
    for r in log:
        by_commit.setdefault(r["_commit_time"], []).append(r)
    for t in sorted(by_commit):
        batch = spark.createDataFrame([(r["k"], r["ord"], r["tb"], r["payload"]) for r in by_commit[t]], schema)
        op = by_commit[t][0]["_op"]
        if op == "O":
            rows = batch  # the model's overwrite keeps duplicates
        elif op == "I":
            rows = ops.insert(rows, batch, "k")
        elif op == "U":
            rows = ops.upsert(rows, batch, "k", "ord", "tb", mode)
        else:
            rows = ops.delete(rows, batch, "k")
        rows = spark.createDataFrame(rows.collect(), schema)
    assert sorted(r.payload for r in rows.collect()) == sorted(p for p, _, _ in replay(log, mode))


def test_create_insert_upsert_delete(spark):
    rows = ops.create(_rides(spark, [("r1", "2023-05-01", "A"), ("r1", "2023-06-01", "B"), ("r2", "2023-01-01", "C")]), **KEYS)
    assert _stations(rows) == [("r1", "B"), ("r2", "C")]
    rows = ops.insert(rows, _rides(spark, [("r3", "2024-01-01", "D"), ("r3", "2024-01-01", "E")]), "ride_id")
    # an upsert that is older than what is stored changes nothing; a newer one moves the key to another year
    rows = ops.upsert(rows, _rides(spark, [("r1", "2022-01-01", "OLD"), ("r2", "2024-02-02", "NEW")]), **KEYS)
    assert _stations(rows) == [("r1", "B"), ("r2", "NEW"), ("r3", "D"), ("r3", "E")]
    assert {r.ride_id: r.year for r in rows.collect()}["r2"] == 2024
    rows = ops.upsert(rows, _rides(spark, [("r3", "2024-03-01", "F")]), **KEYS)
    rows = ops.delete(rows, spark.createDataFrame([("r1",), ("nope",)], "ride_id string"), "ride_id")
    assert _stations(rows) == [("r2", "NEW"), ("r3", "F")]
    # a column that a batch adds is NULL in older rows
    wider = ops.insert(rows, _rides(spark, [("r4", "2024-01-01", "G")]).withColumn("extra", F.lit(1)), "ride_id")
    assert {r.ride_id: r.extra for r in wider.collect()} == {"r2": None, "r3": None, "r4": 1}


@pytest.mark.parametrize("write", ["create", "insert", "upsert"])
def test_null_keys_are_refused(spark, write):
    rows, batch = _rides(spark, [("r1", "2023-05-01", "A")]), _rides(spark, [(None, "2023-05-01", "B")])
    with pytest.raises(Exception, match="ride_id is NULL"):
        (ops.create(batch, **KEYS) if write == "create" else ops.insert(rows, batch, "ride_id") if write == "insert" else ops.upsert(rows, batch, **KEYS)).collect()


def test_null_keys_in_a_log_do_not_pass_in_silence(spark):
    log = spark.createDataFrame([(None, 1, 1, "p", "20240101000000000", "I")], LOG_SCHEMA)
    with pytest.raises(Exception, match="k is NULL"):
        resolve(log, "k", "ord", "tb").collect()


def test_reads_by_name(spark):
    rows = random_log(7, n_commits=20)
    df = spark.createDataFrame([tuple(r[c] for c in ("k", "ord", "tb", "payload", "_commit_time", "_op")) for r in rows], LOG_SCHEMA)
    at = sorted({r["_commit_time"] for r in rows})[9]
    read = lambda how, t=None: sorted((r.payload, r._commit_time, r._op) for r in ops.read(df, how, "k", "ord", "tb", at=t).collect())
    now = replay(rows, "event")
    assert read("snapshot") == read("snap") == now
    assert read("as_of", at) == read("time", at) == replay([r for r in rows if r["_commit_time"] <= at], "event")
    assert read("incremental", at) == read("incr", at) == [r for r in now if r[1] > at]
    for how in ("as_of", "incremental"):
        with pytest.raises(ValueError):
            read(how)
    with pytest.raises(ValueError):
        read("latest")
    times = sorted({r["_commit_time"] for r in rows})
    between = lambda a, b: ops.read(df, "incremental", "k", "ord", "tb", at=a, until=b)
    for a, b in ((times[3], times[9]), (times[9], times[9]), (times[0], times[-1]), (times[5], times[6])):
        then = replay([r for r in rows if r["_commit_time"] <= b], "event")
        assert sorted((r.payload, r._commit_time, r._op) for r in between(a, b).collect()) == [r for r in then if r[1] > a]
    with pytest.raises(ValueError):
        ops.read(df, "as_of", "k", "ord", "tb", at=at, until=at)


def test_an_overwrite_without_rows_empties_the_table(spark):
    log = spark.createDataFrame([("a", 1, 1, "p", "20240101000000000", "I")], LOG_SCHEMA)
    commits = spark.createDataFrame([("20240101000000000", "I"), ("20240102000000000", "O")], "_commit_time string, _op string")
    assert ops.read(log, "snapshot", "k", "ord", "tb", commits=commits).count() == 0


def test_stored_rows_by_date_parts(spark, tmp):
    """Partitioned files, an external table, a view, a lookup that reaches the scan."""
    from gridlake.sources.files import add_date_parts, write_partitioned

    rows = add_date_parts(_rides(spark, [("r1", "2023-05-01", "A"), ("r2", "2024-02-03", "B")]), "started_at", ["year", "month", "day"])
    write_partitioned(rows, f"{tmp}/rides", ["year", "month", "day"], cluster_by=["ride_id"])
    ops.external_table(spark, "rides_by_day", f"{tmp}/rides", ["year", "month", "day"])
    stored = spark.table("rides_by_day")
    assert {r.ride_id: (r.year, r.month, r.day) for r in stored.collect()} == {"r1": (2023, 5, 1), "r2": (2024, 2, 3)}
    assert dict(stored.dtypes)["year"] == "int" and dict(spark.read.parquet(f"{tmp}/rides").dtypes)["year"] == "int"
    found = ops.lookup(stored, ride_id="r1")
    assert [r.station for r in found.collect()] == ["A"]
    assert "EqualTo(ride_id,r1)" in found._jdf.queryExecution().executedPlan().toString()
    ops.temp_view(stored, "rides_now")
    assert spark.sql("SELECT count(*) AS n FROM rides_now WHERE year = 2024").first().n == 1
    spark.catalog.dropTempView("rides_now")
    spark.sql("DROP TABLE rides_by_day")


def test_few_files_for_few_partitions(spark, tmp):
    import glob

    from gridlake.sources.files import write_partitioned

    rows = spark.range(20_000).repartition(16).selectExpr("id", "cast(id % 4 as int) as year")
    write_partitioned(rows, f"{tmp}/few", ["year"])
    assert len(glob.glob(f"{tmp}/few/year=*/*.parquet")) <= 8


def test_bounds_reach_the_scan(spark):
    from gridlake.plans import changelog

    sf = "/root/testdata/sf0.001"
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    log = changelog.events_log(spark, sf, "20240112999999999")
    scans = [x for x in plan(log).splitlines() if "FileScan" in x]
    assert all("LessThan(ts,2024-01-13" in x for x in scans)  # the as-of bound
    assert all("GreaterThanOrEqual(ts,2024-01-01" in x for x in scans)  # the overwrite bound, found once
    assert "GreaterThanOrEqual(ts,2024-01-25" in plan(changelog.recent_log(changelog.events_log(spark, sf), "20240125000000000"))
    days = {r.d for r in changelog.events_log(spark, sf).selectExpr("substr(_commit_time, 7, 2) d").distinct().collect()}
    assert len(days) >= 25  # every day can affect an answer


def test_a_read_between_two_commits_of_a_log_stored_by_day(spark, tmp):
    """Both bounds become partition filters of the scans."""
    from gridlake.plans import changelog

    sf = "/root/testdata/sf0.001"
    log = changelog.events_log(spark, sf).withColumn("day", F.substring("_commit_time", 1, 8))
    log.repartition("day").write.partitionBy("day").parquet(f"{tmp}/log")
    stored = spark.read.schema(log.schema).parquet(f"{tmp}/log")
    a, b = "20240108000000000", "20240117999999999"
    recent = stored.where(F.col("day").between(a[:8], b[:8]))
    got = ops.read(stored.where(F.col("day") <= b[:8]), "incremental", "user_id", "value", "event_id", at=a, until=b, recent=recent, start="", one_per_overwrite=True)
    want = __import__("__spark_entry__").queries()["keyedIncrementalBetween"](spark, sf)
    assert sorted(got.select(want.columns).collect()) == sorted(want.collect()) and got.count() > 10
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    scans = [x for x in got.select("*")._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    assert all("<= 20240117" in x for x in scans) and sum(">= 20240108" in x for x in scans) == 2 and len(scans) == 3


def test_a_snapshot_scans_twice_and_shuffles_the_rows_once(spark):
    import __spark_entry__ as E

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name, scans, shuffles in (("keyedSnapshotEvent", 2, 4), ("keyedSnapshotCommit", 2, 3), ("keyedAsOf", 2, 4)):
            plan = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
            assert plan.count("FileScan") <= scans and plan.count("Exchange hashpartitioning") <= shuffles and "Subquery" not in plan
            assert plan.count("props#") and sum("props" in x for x in plan.splitlines() if "FileScan" in x) == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_copied_log_gains_only_what_is_new(spark, tmp):
    from gridlake.streaming.copy import copy_new

    one = spark.createDataFrame([tuple(r.values()) for r in random_log(3)], LOG_SCHEMA)
    one.write.parquet(f"{tmp}/log")
    for extra in (0, 0, 5):  # run, run again, run after more has been written
        if extra:
            one.limit(extra).write.mode("append").parquet(f"{tmp}/log")
        copy_new(spark, f"{tmp}/log", f"{tmp}/copy", f"{tmp}/checkpoint").awaitTermination()
        assert spark.read.parquet(f"{tmp}/copy").count() == one.count() + extra
