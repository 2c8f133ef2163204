import gzip
import os

from gridlake.sources import files, listing, store


def tree(root, n=300):
    """Nested folders with objects, some of them hidden or empty; the keys in them."""
    keys = set()
    for i in range(n):
        key = f"{'abc'[i % 3]}/{i % 7}/" * (i % 4 > 0) + ("_" if i % 11 == 0 else "") + f"f {i}.csv"
        os.makedirs(os.path.dirname(f"{root}/{key}") or root, exist_ok=True)
        with open(f"{root}/{key}", "w") as f:
            f.write("x" * (i % 5))
        keys.add(key)
    os.makedirs(f"{root}/empty/deep")
    return keys


def test_a_listing_equals_a_walk(spark, tmp):
    keys = tree(f"{tmp}/t")
    rows = listing.list_objects(spark, f"{tmp}/t").collect()
    assert len(rows) == len(keys) and {r.key for r in rows} == keys
    for r in rows:
        s = os.stat(f"{tmp}/t/{r.key}")
        assert r.size == s.st_size and not r.is_dir and abs(r.last_modified.timestamp() - s.st_mtime) < 0.002
        assert r.path == f"file:{tmp}/t/{r.key}"
    for prefix, after in (("a/", ""), ("a/3/f", ""), ("", "b/4"), ("c/", "c/2/f 5"), ("zz", ""), ("f", "f 2")):
        got = {r.key for r in listing.list_objects(spark, f"{tmp}/t", prefix=prefix, start_after=after).collect()}
        assert got == {k for k in keys if k.startswith(prefix) and k > after}
    top = {r.key for r in listing.list_objects(spark, f"{tmp}/t", recursive=False).collect()}
    assert top == {k for k in keys if "/" not in k} | {"a/", "b/", "c/", "empty/"}


def test_the_same_as_the_file_system_says(spark, tmp, monkeypatch):
    tree(f"{tmp}/t", 60)
    spark.range(3).write.csv(f"{tmp}/t/spark.csv")  # with checksum files beside
    ours = listing.list_objects(spark, f"{tmp}/t").collect()
    monkeypatch.setattr(store, "reachable", lambda path: False)
    assert sorted(ours) == sorted(listing.list_objects(spark, f"{tmp}/t").collect())


class Counted(store._Local):
    seen = []

    def entries(self, folder):
        Counted.seen.append(folder)
        yield from super().entries(folder)


def test_folders_that_cannot_hold_wanted_keys_are_not_listed(tmp, monkeypatch):
    keys = tree(f"{tmp}/t")
    monkeypatch.setattr(store, "opened", lambda root, options: Counted(root))

    def run(**options):
        Counted.seen = []
        reader = store.PushedListingReader({"root": f"file:{tmp}/t", **options})
        return reader, lambda: {r for p in reader.partitions() for b in reader.read(p) for r in b.column("key").to_pylist()}

    _, keys_of = run(prefix="b/", start_after="b/3")
    assert keys_of() == {k for k in keys if k.startswith("b/") and k > "b/3"}
    assert all(f.startswith("b/") for f in Counted.seen) and "b/2/" not in Counted.seen
    reader, keys_of = run()
    assert len(list(reader.pushFilters([store.StringStartsWith(("key",), "c/1"), store.GreaterThan(("key",), "c/1/f 4"), store.EqualTo(("size",), 3)]))) == 3
    assert keys_of() == {k for k in keys if k.startswith("c/1") and k > "c/1/f 4"} and set(Counted.seen) <= {"c/", "c/1/"}


def test_the_driver_looks_at_a_bounded_part(tmp, monkeypatch):
    keys = tree(f"{tmp}/t")
    monkeypatch.setattr(store, "PLAN_ENTRIES", 5)
    reader = store.ListingReader({"root": f"file:{tmp}/t"})
    assert reader.partitions() == [store.Folder("", True)]  # its folders aren't known, so one task walks them all
    assert {k for b in reader.read(store.Folder("", True)) for k in b.column("key").to_pylist()} == keys
    monkeypatch.undo()
    for most in (1, 3, 10, 64):
        reader = store.ListingReader({"root": f"file:{tmp}/t", "partitions": str(most)})
        parts = reader.partitions()
        found = [k for p in parts for b in reader.read(p) for k in b.column("key").to_pylist()]
        assert len(found) == len(keys) and set(found) == keys and len(parts) <= most + 7


def test_filters_of_a_query_are_pushed_down(spark, tmp):
    keys = tree(f"{tmp}/t")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = listing.list_objects(spark, f"{tmp}/t").where("key like 'a/%' and key > 'a/2' and size > 1")
        assert {r.key for r in df.collect()} == {k for k in keys if k.startswith("a/") and k > "a/2" and os.stat(f"{tmp}/t/{k}").st_size > 1}
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


def test_only_the_head_of_a_file_is_read_for_its_header(spark, tmp):
    os.makedirs(f"{tmp}/h")
    body = "".join(f"{i},{i}\n" for i in range(400_000))  # five megabytes
    for i in range(6):
        with open(f"{tmp}/h/{i}.csv", "w") as f:
            f.write(("a,b\n" if i % 2 else "b,a\n") + body)
    with gzip.open(f"{tmp}/h/7.csv.gz", "wt") as f:
        f.write("a,b\r\n" + body)
    with open(f"{tmp}/h/8.csv", "w") as f:
        f.write("")
    names = spark.read.format("binaryFile").load(f"{tmp}/h").select("path")
    rows = {os.path.basename(r.path): r for r in store.heads(names, {}).collect()}
    assert {k: r.header for k, r in rows.items()} == {**{f"{i}.csv": "a,b" if i % 2 else "b,a" for i in range(6)}, "7.csv.gz": "a,b"}  # an empty file has none
    assert sum(r.bytes for r in rows.values()) <= 7 * store.HEAD_BYTES < os.stat(f"{tmp}/h/1.csv").st_size
    df = files.scan(spark, f"{tmp}/h/*.csv", schema="a long, b long")
    assert df.count() == 6 * 400_000 and df.where("a <> b").count() == 0


def test_a_long_first_line_is_read_whole(tmp):
    line = ",".join(f"column_{i}" for i in range(20_000))
    with open(f"{tmp}/long.csv", "w") as f:
        f.write(line + "\n1,2\n" * 100_000)
    with open(f"{tmp}/long.csv", "rb", buffering=0) as f:
        got, n = store.first_line(f, False, 1000)
    assert got == line and n <= len(line) + 1000


def test_settings_name_no_more_than_is_needed(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.s3a.endpoint", "http://store:9000")
    conf.set("fs.s3a.session.token", "t")
    try:
        assert set(store.settings(spark)) <= {"endpoint", "access.key", "secret.key", "connection.ssl.enabled"} and store.settings(spark)["endpoint"] == "http://store:9000"
        assert store.reachable("s3a://b/k") and store.reachable("file:/x") and not store.reachable("viewfs://store/in")
    finally:
        conf.unset("fs.s3a.endpoint")
        conf.unset("fs.s3a.session.token")
