"""Column expressions against plain-Python models on many random inputs,
all in one DataFrame per test (one Spark job, thousands of cases)."""

import os
import random

from gridlake.functions import names as N
from gridlake.functions import paths as P

ALPHABET = "ab.-_/A1 "


def _random_keys(n, seed=7):
    rnd = random.Random(seed)
    keys = set()
    while len(keys) < n:
        k = "".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 14)))
        keys.add(k)
    return sorted(keys | {"x.csv.gz", "a/.b.c", "..", ".", "a/", "/a.b/c", "a.b.gz", "c.GZ"})


def test_paths_match_os_path(spark):
    keys = _random_keys(3000)
    df = spark.createDataFrame([(k,) for k in keys], "k string").select(
        "k",
        P.base_name("k").alias("base"),
        P.base_name("k", with_extension=False).alias("stem"),
        P.extension("k").alias("ext"),
        P.file_type("k").alias("ftype"),
        P.strip_extension("k").alias("stripped"),
        P.data_format("k").alias("fmt"),
    )
    for r in df.collect():
        k = r.k
        base = os.path.basename(k)
        stem, ext = os.path.splitext(base)
        assert r.base == base, k
        assert r.stem == stem, k
        assert r.ext == ext, k
        assert r.ftype == ext.lstrip(".") if ext.startswith(".") else r.ftype == ext, k
        assert r.stripped == k[: len(k) - len(ext)], k
        assert r.fmt == P.py_data_format(k), k


def _check(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", N.name_failures("n").alias("f"), N.name_verdict("n").alias("v"))
    return {r.n: (list(r.f), r.v) for r in df.collect()}


def test_names_of_plain_labels_are_valid_and_each_blemish_adds_its_message(spark):
    """Names are built valid, then spoilt in one known way at a time; the message of that way, and no other, appears."""
    rnd = random.Random(11)
    label = lambda: "".join(rnd.choice("abcxyz") for _ in range(rnd.randint(3, 9)))
    spoil = {
        N.MSG_DOUBLE_PERIOD: lambda n: n + ".." + label(),
        N.MSG_DASH_PERIOD: lambda n: n + rnd.choice([".-", "-."]) + label(),
        N.MSG_TRAILING_DASH: lambda n: n + "-",
        N.MSG_CHARSET: lambda n: n + rnd.choice("A !/\u00e9"),
        N.MSG_LENGTH: lambda n: rnd.choice([n[:2], (n + label() * 20)[:64].rstrip("-.") .ljust(64, "a")]),
    }
    good = {rnd.choice(["-", "."]).join(label() for _ in range(rnd.randint(1, 5))) for _ in range(400)}
    bad = {make(n): (n, msg) for n in sorted(good) for msg, make in spoil.items()}
    got = _check(spark, sorted(good | set(bad)))
    for n in good:
        assert got[n] == ([], N.VERDICT_OK), n
    for n, (_, msg) in bad.items():
        if n not in good:
            assert got[n][0] == [msg], n
            assert got[n][1] == N.VERDICT_FAILED + "\n" + msg


def test_failures_of_random_names_are_consistent(spark):
    rnd = random.Random(12)
    names = sorted({"".join(rnd.choice("ab1.-_A9") for _ in range(rnd.randint(0, 70))) for _ in range(3000)})
    got = _check(spark, names)
    order = [N.MSG_LENGTH, N.MSG_CHARSET, N.MSG_UNDERSCORE, N.MSG_TRAILING_DASH, N.MSG_DOUBLE_PERIOD, N.MSG_DASH_PERIOD, N.MSG_IP_FORM]
    for n, (fails, verdict) in got.items():
        assert fails == [m for m in order if m in fails]  # each at most once, in the fixed order
        assert (N.MSG_UNDERSCORE in fails) <= (N.MSG_CHARSET in fails)  # an underscore is no allowed character either
        assert verdict.split("\n") == ([N.VERDICT_FAILED, *fails] if fails else [N.VERDICT_OK])
        assert (N.MSG_LENGTH in fails) == (len(n) not in range(3, 64))


def test_addresses_are_no_names(spark):
    rnd = random.Random(13)
    octets = [".".join(str(rnd.randint(0, 999)) for _ in range(4)) for _ in range(50)]
    got = _check(spark, octets + [o + ".x" for o in octets] + [o.rpartition(".")[0] for o in octets])
    for o in octets:
        assert got[o][0] == [N.MSG_IP_FORM] and got[o + ".x"][0] == [] and got[o.rpartition(".")[0]][0] == []
