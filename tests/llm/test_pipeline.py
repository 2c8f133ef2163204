import re

import corpus_pipeline as P
from gridlake.llm import secret_scan

from test_jaccard import brute
from test_texts import marks

SF = "/root/testdata/sf0.001"


def test_every_stage_on_its_own_input(spark, tmp):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    seen = {}
    for name, apply in P.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        apply(spark, docs, SF).write.parquet(f"{tmp}/{name}")
        docs = spark.read.parquet(f"{tmp}/{name}")
        seen[name] = (before, docs.collect())
        if name != "packing":
            assert docs.columns == P.COLUMNS
    before, after = seen["language"]
    assert len(after) >= 0.95 * len(before)
    before, after = seen["near_duplicates"]
    groups = brute([(i, r.text) for i, r in before.items()], 5, 80, 100)
    assert {r.doc_id for r in after} == {i for i, (_, c) in groups.items() if i == c}
    before, after = seen["decontamination"]
    for i, r in before.items():
        n, hit, _ = marks(r.text, items, 13)
        mine = [x for x in after if x.doc_id == i]
        assert len(mine) == (not (hit and 20 * hit >= n))
        assert hit or not mine or mine[0] == r
    before, after = seen["secrets"]
    assert {r.doc_id for r in after} == set(before)
    for r in after:
        assert not re.search(r"AKIA[0-9A-Z]{16}|(password|token)\W{1,4}[0-9a-f]{18,}", r.text)
        assert secret_scan.MARK in r.text or r == before[r.doc_id]
        assert r.n_chars == len(r.text)
    before, after = seen["packing"]
    assert {r.doc_id for r in after} == set(before)


def test_run_equals_its_stages(spark, tmp):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, apply in P.STAGES:
        apply(spark, docs, SF).write.parquet(f"{tmp}/{name}")
        docs = spark.read.parquet(f"{tmp}/{name}")
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, docs.select(cols).collect())) == sorted(map(tuple, P.run(spark, SF).select(cols).collect()))


def test_odd_and_empty_documents(spark, odd_docs, no_docs, tmp):
    for which, docs in (("odd", odd_docs), ("none", no_docs)):
        for name, apply in P.STAGES:
            apply(spark, docs, SF).write.parquet(f"{tmp}/{which}-{name}")
            docs = spark.read.parquet(f"{tmp}/{which}-{name}")
        if which == "odd":
            assert {r.doc_id for r in docs.collect()} == {1, 5, 8, None}
        else:
            assert docs.count() == 0
