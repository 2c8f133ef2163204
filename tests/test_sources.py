import gzip
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridlake.functions import paths as P
from gridlake.sources import export, files, listing


def _write(path, text, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        with open(path, "w") as f:
            f.write(text)


CSV = "raceId,year,name\n1,2021,Bahrain\n2,2021,Imola\n3,2024,Monaco\n"


@pytest.fixture()
def bucket(tmp):
    root = os.path.join(tmp, "bucket")
    _write(f"{root}/raw/races.csv", CSV)
    _write(f"{root}/raw/gz/drivers.csv.gz", "driverId,forename,surname\n1,Max,V\n2,Lewis,\\N\n", gz=True)
    _write(f"{root}/raw/results.csv", "resultId,rank\n1,\\N\n2,1\n3,20\n")
    _write(f"{root}/raw/notes.txt", "line one\nline two\n")
    _write(f"{root}/raw/status.json", '{"statusId": 1, "status": "Finished"}\n{"statusId": 2, "status": "+1 Lap"}\n')
    _write(f"{root}/raw/a.csv.d/x.csv", "k,v\n1,a\n")
    _write(f"{root}/raw/noext", "k\n1\n")
    _write(f"{root}/raw/xcsv", "k\n1\n")
    pq.write_table(pa.table({"constructorId": [1, 2], "name": ["Red Bull", "Ferrari"]}), f"{root}/raw/constructors.parquet")
    return root


def test_scan_by_extension(spark, bucket):
    races = files.scan(spark, f"{bucket}/raw/races.csv")
    assert races.count() == 3
    assert dict(races.dtypes)["raceId"] == "int"
    drivers = files.scan(spark, f"{bucket}/raw/gz/drivers.csv.gz")
    assert drivers.count() == 2
    assert files.scan(spark, f"{bucket}/raw/notes.txt").count() == 2
    assert files.scan(spark, f"{bucket}/raw/status.json").count() == 2
    assert files.scan(spark, f"{bucket}/raw/constructors.parquet").count() == 2
    with pytest.raises(ValueError):
        files.scan(spark, f"{bucket}/raw/noext")


def test_null_marker_strict_and_clean(spark, bucket):
    strict = files.scan(spark, f"{bucket}/raw/results.csv")
    assert dict(strict.dtypes)["rank"] == "string"
    assert sorted(r.rank for r in strict.collect()) == ["1", "20", "\\N"]
    clean = files.scan(spark, f"{bucket}/raw/results.csv", null_marker=files.CSV_NULL_MARKER)
    assert dict(clean.dtypes)["rank"] == "int"
    assert sorted((r.rank is None) for r in clean.collect()) == [False, False, True]


def test_glob_scan(spark, bucket):
    # races.csv and results.csv have other headers: columns go by name
    both = files.scan(spark, f"{bucket}/raw/*.csv")
    assert set(both.columns) == {"raceId", "year", "name", "resultId", "rank"}
    assert both.where("raceId is not null and rank is null").count() == 3
    assert both.where("raceId is null and rank is not null").count() == 3


def test_query_file(spark, bucket):
    df = files.query_file(spark, f"{bucket}/raw/constructors.parquet")
    assert sorted(r.name for r in df.collect()) == ["Ferrari", "Red Bull"]


def test_listing_and_prefix(spark, bucket):
    lst = listing.list_objects(spark, bucket)
    keys = sorted(r.key for r in lst.collect())
    assert "raw/a.csv.d/x.csv" in keys and "raw/gz/drivers.csv.gz" in keys
    top = listing.list_objects(spark, bucket, prefix="raw/", recursive=False)
    entries = {r.key: r.is_dir for r in top.collect()}
    assert entries["raw/gz/"] is True and entries["raw/a.csv.d/"] is True
    assert entries["raw/races.csv"] is False
    after = listing.list_objects(spark, bucket, start_after="raw/races.csv")
    assert all(r.key > "raw/races.csv" for r in after.collect())
    assert listing.prefix_exists(spark, bucket, "raw/gz")
    assert not listing.prefix_exists(spark, bucket, "nothing/here")
    assert listing.list_objects(spark, bucket + "/missing").count() == 0


def test_path_expressions(spark):
    keys = ["a/b.csv", "a.csv.d/x.csv", "a/.bashrc", "x.csv.gz", "noext", "xcsv", "a/b.", "a..b", "dir/"]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select(
        "k",
        P.extension("k").alias("ext"),
        P.file_type("k").alias("t"),
        P.base_name("k", False).alias("stem"),
        P.data_format("k").alias("fmt"),
        P.is_valid_format("k").alias("valid"),
        P.converted_key("k", "parquet").alias("conv"),
        P.converted_key("k", "parquet", "inputs").alias("conv_dir"),
    )
    got = {r.k: r for r in df.collect()}
    for k in keys:
        stem, ext = os.path.splitext(os.path.basename(k))
        assert got[k].ext == ext, k
        assert got[k].stem == stem, k
        assert got[k].t == P.py_file_type(k)
        assert got[k].fmt == P.py_data_format(k)
    assert got["x.csv.gz"].fmt == "csv"
    assert got["xcsv"].valid is False and got["a/b.csv"].valid is True
    assert got["a.csv.d/x.csv"].conv == "a.csv.d/x.parquet"
    assert got["noext"].conv is None
    assert got["a/b.csv"].conv_dir == "inputs/b.parquet"


def test_file_table_roundtrip_and_convert(spark, bucket, tmp):
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_data")
    files.file_to_table(spark, f"{bucket}/raw/races.csv", "raw_data.races")
    assert spark.table("raw_data.races").count() == 3
    out = files.table_to_file(spark, "raw_data.races", f"{tmp}/out/races.orc", "orc")
    assert spark.read.orc(out).count() == 3
    tgt = files.convert_file(spark, f"{bucket}", "raw/races.csv", f"{tmp}/conv")
    assert tgt.endswith("conv/raw/races.parquet")
    assert spark.read.parquet(tgt).count() == 3
    assert files.convert_file(spark, bucket, "raw/noext", f"{tmp}/conv") is None
    done = files.bulk_convert(spark, bucket, f"{tmp}/bulk", target_dir="inputs/")
    got = {r.key: r.target for r in done.collect()}
    assert "raw/xcsv" not in got and "raw/noext" not in got
    assert got["raw/gz/drivers.csv.gz"].endswith("inputs/drivers.csv.parquet")
    assert all(r.reason is None for r in done.collect())
    assert spark.read.parquet(got["raw/status.json"]).count() == 2


def test_bucket_to_tables(spark, bucket):
    made = files.bucket_to_tables(spark, bucket, database="f1raw", prefix="raw/")
    assert "f1raw.races" in made and "f1raw.drivers" in made and "f1raw.constructors" in made
    assert spark.table("f1raw.drivers").count() == 2
    # a known schema skips inference
    files.bucket_to_tables(spark, bucket, database="f1raw2", prefix="raw/", schemas={"races": "raceId long, year long, name string"})
    assert dict(spark.table("f1raw2.races").dtypes)["year"] == "bigint"


def test_export_import_roundtrip(spark, tmp):
    spark.sql("DROP DATABASE IF EXISTS exp_src CASCADE")
    spark.sql("CREATE DATABASE exp_src")
    big = spark.range(250_000).select(F.col("id"), (F.col("id") % 7).alias("g"))
    big.write.saveAsTable("exp_src.big")
    spark.createDataFrame([(1, "a|b"), (2, "c")], "k int, v string").write.saveAsTable("exp_src.pipes")
    spark.sql("CREATE VIEW exp_src.big_g AS SELECT g, count(*) AS n FROM exp_src.big GROUP BY g")
    # a view over a view, named so it sorts first
    spark.sql("CREATE VIEW exp_src.a_top AS SELECT max(n) AS m FROM exp_src.big_g")
    out = f"{tmp}/export"
    export.export_database(spark, out, ["exp_src"], "parquet")
    # 100,000-row groups, zstd
    part_files = [f for f in os.listdir(f"{out}/exp_src/big") if f.endswith(".parquet")]
    sizes = []
    for f in part_files:
        md = pq.ParquetFile(f"{out}/exp_src/big/{f}").metadata
        sizes += [md.row_group(i).num_rows for i in range(md.num_row_groups)]
        assert md.row_group(0).column(0).compression == "ZSTD"
    assert max(sizes) <= 100_000 and sum(sizes) == 250_000
    spark.sql("DROP DATABASE exp_src CASCADE")
    export.import_database(spark, out)
    assert spark.table("exp_src.big").count() == 250_000
    assert spark.table("exp_src.big_g").count() == 7
    assert spark.table("exp_src.a_top").first().m > 0
    # CSV with the two-character delimiter round-trips values holding one '|'
    out2 = f"{tmp}/export_csv"
    export.export_database(spark, out2, ["exp_src"], "csv")
    back = spark.read.csv(f"{out2}/exp_src/pipes", sep="||", header=True)
    assert sorted(r.v for r in back.collect()) == ["a|b", "c"]
    with pytest.raises(ValueError):
        export.export_database(spark, f"{tmp}/x", ["exp_src"], "xml")
    with pytest.raises(files.MissingConnector):
        export.export_database(spark, f"{tmp}/y", ["exp_src"], "avro")


def test_bulk_convert_by_folder(spark, tmp):
    root = os.path.join(tmp, "many")
    for i in range(6):
        _write(f"{root}/laps/2024/part{i}.csv", f"lap,ms\n{i},{i * 10}\n{i + 100},{i}\n")
    _write(f"{root}/laps/2023/x.csv", "lap,ms\n1,2\n")
    done = files.bulk_convert(spark, root, f"{tmp}/out", by_folder=True)
    got = {r.key: r.target for r in done.collect()}
    assert len(got) == 7 and len(set(got.values())) == 2
    t2024 = got["laps/2024/part0.csv"]
    assert t2024.endswith("laps/2024.parquet")
    assert spark.read.parquet(t2024).count() == 12


def test_prefix_with_glob_characters(spark, tmp):
    _write(f"{tmp}/gl/data[1]/x.csv", "a\n1\n")
    _write(f"{tmp}/gl/dataX/y.csv", "a\n1\n")
    assert listing.prefix_exists(spark, f"{tmp}/gl", "data[1]")
    assert not listing.prefix_exists(spark, f"{tmp}/gl", "data[2]")
    assert not listing.prefix_exists(spark, f"{tmp}/gl", "data*Z")


def test_bucket_to_tables_quotes_names(spark, tmp):
    _write(f"{tmp}/q/lap-times.csv", "lap,ms\n1,2\n")
    made = files.bucket_to_tables(spark, f"{tmp}/q", database="qraw")
    assert made == ["qraw.lap_times"]
    assert spark.table("qraw.lap_times").count() == 1


def test_bucket_to_tables_same_name_in_folders(spark, tmp):
    _write(f"{tmp}/y/2023/results.csv", "id,v\n1,a\n2,b\n")
    _write(f"{tmp}/y/2024/results.csv", "id,v\n3,c\n")
    _write(f"{tmp}/y/2024/deep/results.csv.gz", "id,v\n4,d\n", gz=True)
    made = files.bucket_to_tables(spark, f"{tmp}/y", database="yr")
    assert made == ["yr.results"]
    assert sorted(r.id for r in spark.table("yr.results").collect()) == [1, 2, 3, 4]
    # a prefix that ends mid-name falls back to exact paths
    files.bucket_to_tables(spark, f"{tmp}/y", database="yr2", prefix="2024/res")
    assert sorted(r.id for r in spark.table("yr2.results").collect()) == [3]


def test_bulk_convert_by_folder_gz_and_subfolders(spark, tmp):
    _write(f"{tmp}/g/laps/a.csv", "lap\n1\n")
    _write(f"{tmp}/g/laps/b.csv.gz", "lap\n2\n", gz=True)
    _write(f"{tmp}/g/laps/sub/c.csv", "lap\n3\n")
    done = {r.key: r.target for r in files.bulk_convert(spark, f"{tmp}/g", f"{tmp}/o", by_folder=True).collect()}
    assert done["laps/a.csv"] == done["laps/b.csv.gz"]
    assert sorted(r.lap for r in spark.read.parquet(done["laps/a.csv"]).collect()) == [1, 2]
    assert sorted(r.lap for r in spark.read.parquet(done["laps/sub/c.csv"]).collect()) == [3]


@pytest.mark.parametrize("fmt", ["json", "orc"])
def test_export_import_json_orc(spark, tmp, fmt):
    db = f"exp_{fmt}"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db}")
    spark.createDataFrame([(1, "a"), (2, None)], "k bigint, v string").write.saveAsTable(f"{db}.t")
    export.export_database(spark, f"{tmp}/e_{fmt}", [db], fmt)
    spark.sql(f"DROP DATABASE {db} CASCADE")
    export.import_database(spark, f"{tmp}/e_{fmt}")
    assert sorted((r.k, r.v) for r in spark.table(f"{db}.t").collect()) == [(1, "a"), (2, None)]


def test_same_stems_all_arrive(spark, tmp):
    for year, n in ((2023, 1), (2024, 2)):
        _write(f"{tmp}/s/{year}/results.csv", "id,v\n" + "".join(f"{year}{i},a\n" for i in range(n)))
    _write(f"{tmp}/s/2024/results.json", '{"id": 9, "v": "j"}\n')
    _write(f"{tmp}/s/2024/races.csv", "id\n1\n")
    done = {r.key: r.target for r in files.bulk_convert(spark, f"{tmp}/s", f"{tmp}/o").collect()}
    assert len(set(done.values())) == 4 and done["2024/races.csv"].endswith("/o/inputs/races.parquet")
    assert {k: spark.read.parquet(t).count() for k, t in done.items()} == {
        "2023/results.csv": 1, "2024/results.csv": 2, "2024/results.json": 1, "2024/races.csv": 1,
    }
    # a folder's target that another folder's would overwrite is refused before anything is written
    _write(f"{tmp}/c/a/x.csv", "id\n1\n")
    _write(f"{tmp}/c/a/x.json", '{"id": 1}\n')
    _write(f"{tmp}/c/a.csv/x.json", '{"id": 1}\n')
    _write(f"{tmp}/c2/a/x.csv", "id\n1\n")
    with pytest.raises(ValueError, match="nothing was written"):
        files._refuse_shared_targets(spark.createDataFrame([("t",), ("t",)], "target string"))


def test_columns_go_by_name(spark, tmp):
    _write(f"{tmp}/n/2023/results.csv", "id,grid,points\n1,10,25\n")
    _write(f"{tmp}/n/2024/results.csv", "id,points,grid,note\n2,18,20,x\n")
    want = [(1, 10, 25, None), (2, 20, 18, "x")]
    cols = ["id", "grid", "points", "note"]
    files.bucket_to_tables(spark, f"{tmp}/n", database="byname")
    assert sorted(tuple(r) for r in spark.table("byname.results").select(cols).collect()) == want
    files.bucket_to_tables(spark, f"{tmp}/n", database="byname2", schemas={"results": "id int, points long, grid int"})
    typed = spark.table("byname2.results")
    assert typed.dtypes == [("id", "int"), ("points", "bigint"), ("grid", "int")]
    assert sorted(tuple(r) for r in typed.collect()) == [(1, 25, 10), (2, 18, 20)]
    _write(f"{tmp}/f/laps/a.csv", "id,grid,points\n1,10,25\n")
    _write(f"{tmp}/f/laps/b.csv", "id,points,grid,note\n2,18,20,x\n")
    one = files.bulk_convert(spark, f"{tmp}/f", f"{tmp}/fo", by_folder=True).first().target
    assert sorted(tuple(r) for r in spark.read.parquet(one).select(cols).collect()) == want


def test_no_column_is_lost_between_parquet_files(spark, tmp):
    os.makedirs(f"{tmp}/p/1"), os.makedirs(f"{tmp}/p/2")
    pq.write_table(pa.table({"id": [1]}), f"{tmp}/p/1/t.parquet")
    pq.write_table(pa.table({"id": [2], "extra": ["x"]}), f"{tmp}/p/2/t.parquet")
    files.bucket_to_tables(spark, f"{tmp}/p", database="merged")
    assert sorted((r.id, r.extra) for r in spark.table("merged.t").collect()) == [(1, None), (2, "x")]


def test_what_is_not_read_is_reported(spark, tmp):
    _write(f"{tmp}/r/_hidden.csv", "a\n1\n")
    _write(f"{tmp}/r/.dot.csv", "a\n1\n")
    _write(f"{tmp}/r/seen.csv", "a\n1\n")
    _write(f"{tmp}/r/bare.gz", "a\n1\n2\n", gz=True)
    assert {r.key for r in listing.list_objects(spark, f"{tmp}/r").collect()} == {"_hidden.csv", ".dot.csv", "seen.csv", "bare.gz"}
    with pytest.warns(files.SkippedFiles, match="3 objects"):
        done = {r.key: (r.target, r.reason) for r in files.bulk_convert(spark, f"{tmp}/r", f"{tmp}/ro").collect()}
    assert done["bare.gz"] == (None, "no format inside .gz") and done["_hidden.csv"][0] is None and done["seen.csv"][1] is None
    with pytest.warns(files.SkippedFiles, match="2 objects"):
        made = files.bucket_to_tables(spark, f"{tmp}/r", database="gz_raw", gz_format="csv")
    assert "gz_raw.bare" in made and spark.table("gz_raw.bare").count() == 2


def test_convert_then_load(spark, bucket, tmp):
    """The reference's chain: the raw bucket is converted, and the converted bucket loaded by base name."""
    files.bulk_convert(spark, bucket, f"{tmp}/zone")
    made = files.bucket_to_tables(spark, f"{tmp}/zone", database="zone", prefix="inputs/")
    assert {"zone.races", "zone.results", "zone.status", "zone.constructors"} <= set(made)
    assert not any("part" in m for m in made)
    assert sorted(r.name for r in spark.table("zone.races").collect()) == ["Bahrain", "Imola", "Monaco"]


def test_long_listings_are_written_in_pieces(spark, tmp, monkeypatch):
    for i in range(25):
        _write(f"{tmp}/many/d{i % 3}/f{i}.csv", "a\n1\n")
    monkeypatch.setattr(listing, "CHUNK", 10)
    monkeypatch.setattr(listing.store, "reachable", lambda path: False)  # as on a file system that tasks can't reach
    assert listing.list_objects(spark, f"{tmp}/many").count() == 25
    assert listing.list_objects(spark, f"{tmp}/many", prefix="d1/f1").count() == len([i for i in range(25) if i % 3 == 1 and str(i).startswith("1")])


def test_existence_stops_at_the_first_match(spark, tmp, monkeypatch):
    from gridlake.sources import fs

    for i in range(20):
        _write(f"{tmp}/ex/f{i}.csv", "a\n")
    seen = []
    entry = fs._entry
    monkeypatch.setattr(fs, "_entry", lambda s: seen.append(1) or entry(s))
    assert listing.prefix_exists(spark, f"{tmp}/ex", "f") and len(seen) == 1


VALUES = [("007", "1.50", ""), (None, "", "a||b"), (" x ", 'say "hi"', "two\nlines"), ("\\N", "null", "1e5")]


@pytest.mark.parametrize("fmt", ["csv", "parquet", "json", "orc"])
def test_an_import_gives_back_what_was_exported(spark, tmp, fmt):
    import datetime as dt

    db = f"lossless_{fmt}"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db}")
    rows = [(*v, i, i / 7, dt.datetime(2024, 1, 1, 1, 2, 3, 456789), dt.date(2024, 2, 29), f"r{i % 2}") for i, v in enumerate(VALUES)]
    df = spark.createDataFrame(rows, "a string, b string, c string, n int, x double, t timestamp, d date, race_type string")
    df.write.partitionBy("race_type").saveAsTable(f"{db}.kept")
    df.write.saveAsTable(f"{db}.b_c")
    export.export_database(spark, f"{tmp}/e", [db], fmt)
    spark.sql(f"DROP DATABASE {db} CASCADE")
    os.rename(f"{tmp}/e", f"{tmp}/moved")
    export.import_database(spark, f"{tmp}/moved")
    key = lambda r: r[3]
    for name in ("kept", "b_c"):
        back = spark.table(f"{db}.{name}").select(df.columns)
        assert back.dtypes == df.dtypes and sorted(map(tuple, back.collect()), key=key) == rows
    assert [c.name for c in spark.catalog.listColumns(f"{db}.kept") if c.isPartition] == ["race_type"]
    if fmt == "csv":
        spark.createDataFrame([(export.CSV_EXPORT_NULL,)], "a string").write.saveAsTable(f"{db}.marked")
        with pytest.raises(ValueError, match="stands for NULL"):
            export.export_database(spark, f"{tmp}/e2", [db], fmt)


def test_exports_of_two_databases_do_not_meet(spark, tmp):
    for db, name in (("ex_a_b", "c"), ("ex_a", "b_c")):
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
        spark.sql(f"CREATE DATABASE {db}")
        spark.createDataFrame([(db,)], "v string").write.saveAsTable(f"{db}.{name}")
    export.export_database(spark, f"{tmp}/two", ["ex_a_b", "ex_a"])
    for db in ("ex_a_b", "ex_a"):
        spark.sql(f"DROP DATABASE {db} CASCADE")
    export.import_database(spark, f"{tmp}/two")
    assert spark.table("ex_a_b.c").first().v == "ex_a_b" and spark.table("ex_a.b_c").first().v == "ex_a"
