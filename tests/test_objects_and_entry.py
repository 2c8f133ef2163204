import os

import duckdb
import pytest

from gridlake.functions import names as N
from gridlake.plans.objects import listing_report, name_checks

SF001 = "/root/testdata/sf0.001"


def test_name_rules(spark):
    cases = {
        "ab": [N.MSG_LENGTH],
        "abc": [],
        "a" * 63: [],
        "a" * 64: [N.MSG_LENGTH],
        "A": [N.MSG_LENGTH, N.MSG_CHARSET],
        "a_b": [N.MSG_CHARSET, N.MSG_UNDERSCORE],
        "ab-": [N.MSG_TRAILING_DASH],
        "a..b": [N.MSG_DOUBLE_PERIOD],
        "a.-b": [N.MSG_DASH_PERIOD],
        "a-.b": [N.MSG_DASH_PERIOD],
        "192.168.0.1": [N.MSG_IP_FORM],
    }
    df = spark.createDataFrame([(k,) for k in cases] + [(None,)], "name string")
    got = {r.name: r for r in name_checks(df).select("name", "verdict", "n_failures", N.name_failures("name").alias("f")).collect()}
    for name, msgs in cases.items():
        assert got[name].f == msgs, name
        want = N.VERDICT_OK if not msgs else "\n".join([N.VERDICT_FAILED] + msgs)
        assert got[name].verdict == want
        assert got[name].n_failures == len(msgs)
    assert got[None].verdict is None


def test_listing_report(spark, tmp):
    root = os.path.join(tmp, "b")
    for k in ("in/a.csv", "in/b.csv.gz", "in/c", "in/d.xcsv"):
        os.makedirs(os.path.dirname(os.path.join(root, k)), exist_ok=True)
        open(os.path.join(root, k), "w").write("x\n1\n")
    rep = {r.key: r for r in listing_report(spark, root).collect()}
    assert rep["in/a.csv"].valid and rep["in/a.csv"].target_in_dir == "inputs/a.parquet"
    assert rep["in/b.csv.gz"].read_format == "csv"
    assert rep["in/c"].target_key is None
    assert not rep["in/d.xcsv"].valid


def test_entry_and_registry(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["driver_name", "driver_points"]
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    # every registered query runs at sf0.001 and agrees with its oracle on row count
    con = duckdb.connect()
    for t in ("customer", "supplier", "part", "orders", "lineitem", "events", "pages", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    for name in ("driverPoints", "keyedSnapshotEvent", "bucketNameRules", "pageUrlParts"):
        spark_n = q[name](spark, SF001).count()
        duck_n = con.sql(o[name]).fetchall()
        assert spark_n == len(duck_n), name
