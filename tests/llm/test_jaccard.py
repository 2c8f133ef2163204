import random
import re

import numpy as np
import pytest

from gridlake.llm import jaccard_join as J
from gridlake.llm.components import components


def shingle_set(text, k):
    w = re.findall(rb"[^\x20\x09-\x0d]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, num, den):
    sets = {i: shingle_set(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def documents(seed, n=160):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.choice([1, 2, 3, 6, 12, 30, 80, 300]))] for _ in range(25)]
    rows = []
    for i in range(n):
        w = list(base[0] if i < n // 3 else rng.choice(base))
        for _ in range(rng.randrange(0, 1 + len(w) // 12)):
            w[rng.randrange(len(w))] = rng.choice(words)
        if rng.random() < 0.2:
            w = w[: -1 - len(w) // 20] or w
        rows.append((i, " ".join(w).upper() if rng.random() < 0.1 else "  ".join(w)))
    return rows + [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one"), (905, "one two")]


@pytest.mark.parametrize("seed,k,num,den", [(1, 3, 90, 100), (2, 5, 80, 100), (3, 2, 1, 2)])
def test_components_equal_all_pairs(spark, seed, k, num, den, monkeypatch):
    monkeypatch.setattr(J, "TILE", 8)  # large cells and centres are dealt out
    monkeypatch.setattr(J, "PART", 8)
    rows = documents(seed)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, cell string, n long")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_join(df, k, num, den).collect()}
    assert got == brute(rows, k, num, den)


def test_neither_texts_nor_cells_are_dealt_again(spark, monkeypatch):
    """Verifications bring pairs to the texts; families are told from pairs, not from cells."""
    plans = {"verified": [], "open": []}

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    verified, write = J._verified, J.Stage.write

    def spy_verified(pairs, docs, *a):
        out = verified(pairs, docs, *a)
        plans["verified"].append(plan(out))
        return out

    def spy_write(self, df, name, *a, **k):
        if name == "open":
            plans["open"].append(plan(df))
        return write(self, df, name, *a, **k)

    monkeypatch.setattr(J, "_verified", spy_verified)
    monkeypatch.setattr(J.Stage, "write", spy_write)
    settings = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in settings:
        spark.conf.set(k, "-1")
    try:
        rows = documents(4, 60)
        tables = spark.catalog.listTables()
        df = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_join(df, 3, 90, 100).collect()}
        assert got == brute(rows, 3, 90, 100)
        assert spark.catalog.listTables() == tables  # none is left
    finally:
        for k, v in settings.items():
            spark.conf.set(k, v)
    assert len(plans["verified"]) == 3 and len(plans["open"]) == 1
    assert all(len(re.findall(r"Exchange hashpartitioning\(doc_id", p)) == 1 for p in plans["verified"])
    assert "cell" not in plans["open"][0]


def test_a_chain_links_its_ends(spark):
    words = [f"v{i}" for i in range(200)]
    rows = [(i, " ".join(words[i * 2 : i * 2 + 100])) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in J.jaccard_join(df, 3, 90, 100).collect()}
    assert got == {i: c for i, (_, c) in brute(rows, 3, 90, 100).items()} and set(got.values()) == {0}


def test_odd_rows(spark, odd_docs, no_docs):
    got = J.jaccard_join(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {(r.n_shingles, r.component_id) for r in got if r.doc_id in (2, 3, 4)} == {(0, 2), (0, 3), (0, 4)}
    assert J.jaccard_join(no_docs).count() == 0


def test_tree_admits_what_the_bound_admits():
    rng = np.random.default_rng(5)
    p = rng.poisson(rng.choice([1, 4, 20], (500, 1)), (500, J.DIMS)).astype(np.int64)
    p[250:] = np.maximum(0, p[:250] + rng.integers(-1, 2, (250, J.DIMS)))
    tree = J.RTree(p, p.sum(1))
    some = np.arange(0, 500, 7)
    found = [np.stack(x, 1) for x in tree.search(p[some], p[some].sum(1), 80, 100)]
    found = np.concatenate(found)
    for q, i in enumerate(some.tolist()):
        need = J._needed(p.sum(1), p[i].sum(), 80, 100)
        want = np.flatnonzero(np.minimum(p, p[i]).sum(1) >= need)
        assert sorted(found[found[:, 0] == q, 1].tolist()) == want.tolist()


def test_pigeonhole_classes():
    c = J.Classes(90, 100)
    for a in range(1, 400):
        for b in range(a, a * 100 // 90 + 1):
            (_, ka), (_, kb) = c.of(np.array([a])), c.of(np.array([b]))
            k = kb[0]
            assert k in ka
            inter = -(-90 * (a + b) // 190)
            assert c.groups[k] - (a + b - 2 * inter) >= 1 + c.spare[k]


def cut(sets):
    return np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])


def test_unlike_sets_share_no_cells():
    """Sets of fewer shingles than their class is made for have more empty groups than are spare."""
    rng = np.random.default_rng(11)
    sets = [np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in rng.integers(560, 1200, 1500).tolist()]
    row, key = J._cells(*cut(sets), J.Classes(80, 100))[:2]
    shared = len(key) - len(np.unique(key))
    assert len(set(row.tolist())) == len(sets) and shared < len(sets) // 10, shared


@pytest.mark.parametrize("num,part", [(80, 1), (90, 1), (80, 2), (50, 1)])
def test_linked_sets_keep_a_cell(num, part):
    """Whatever the order in which frequent cells are left out, also with many more empty groups than are spare."""
    rng = np.random.default_rng(12)
    classes = J.Classes(num, 100)
    for n in (8, 9, 15, 16, 40, 100, 333, 700, 1500):
        for _ in range(30):
            # With part 2, shingles of half of the groups only.
            h = rng.integers(0, 1 << 63, 2 * n * part, dtype=np.uint64)
            h = h[J.T.mix(h ^ J._B) >> np.uint64(63) == 0] if part == 2 else h
            inter = n * num // 100 + 1
            own = (100 * inter // num - inter) // 2  # of each, so that they are just linked
            h = h[: inter + 2 * own]
            a, b = np.sort(h[: inter + own]), np.sort(np.concatenate([h[:inter], h[inter + own :]]))
            assert 100 * inter >= num * (inter + 2 * own) and len(b) == inter + len(h) - inter - own
            row, key, leave = J._cells(*cut([a, b]), classes)
            kept = []
            for i in (0, 1):
                mine = np.sort(key[row == i] * np.uint64(0x9E3779B97F4A7C15))  # any one order
                kept.append(set(mine[leave[i] :].tolist()))
            assert kept[0] & kept[1]


def test_a_line_that_many_documents_have_is_no_cell(spark, monkeypatch):
    rng = random.Random(13)
    line = " ".join(f"line{i}" for i in range(7))
    rows = [(i, line + "\n" + " ".join(f"w{rng.randrange(10**9)}" for _ in range(300))) for i in range(80)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(20)]
    seen, write = {}, J.Stage.write

    def spy(self, df, name, *a, **k):
        out = write(self, df, name, *a, **k)
        seen[name] = out.count()
        return out

    monkeypatch.setattr(J.Stage, "write", spy)
    monkeypatch.setattr(J, "OFTEN", 2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows, 5, 80, 100)
    assert seen["families"] == 40 and seen["open"] == 0  # the linked pairs only


def test_ids_with_several_texts_keep_each_text_s_links(spark):
    rng = random.Random(14)
    words = [[f"w{rng.randrange(10**9)}" for _ in range(120)] for _ in range(40)]
    rows = [(i % 20, " ".join(w)) for i, w in enumerate(words)] + [(100 + i, " ".join(w[:-2])) for i, w in enumerate(words)] * 9
    got = {(r.doc_id, r.component_id) for r in J.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()}
    assert got == {(i, i % 20 if i < 20 else (i - 100) % 20) for i in [*range(20), *range(100, 140)]}


def test_components_of_a_star_and_a_path(spark):
    edges = [(5, i) for i in range(100, 300)] + [(i, i + 1) for i in range(1000, 1040)] + [(7, 7), (None, 3), (3, 9), (9, 3)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    want = {5: 5, 3: 3, 9: 3} | {i: 5 for i in range(100, 300)} | {i: 1000 for i in range(1000, 1041)}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_brief_points_are_never_less():
    rng = np.random.default_rng(6)
    for n in (0, 5, 5000, 200_000):
        h = np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        point = J.points(h, np.array([0, n]))[0]
        short, unit = J.brief(point)
        counts = J.folded([point, bytes(4 * J.DIMS)])[0]
        upper = np.frombuffer(short, np.uint8).astype(int) * unit
        assert counts.sum() == n and (upper >= counts).all() and (upper < counts + unit).all()


def test_points_bound_the_overlap():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 90, 300, 300, 700, 5000)]
    sets += [np.unique(np.concatenate([s[: len(s) // 2 + 1], sets[3][:40]])) for s in sets]
    cuts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    point = J.points(np.concatenate(sets), cuts)
    short = [J.brief(p, len(p) // 4) for p in point]
    held = J.Points([b for b, _ in short], np.array([u for _, u in short]))
    for i, mine in enumerate(sets):
        got = held.overlap(np.full(len(sets), i), np.arange(len(sets)))
        want = [len(np.intersect1d(mine, other)) for other in sets]
        assert (got >= want).all() and got[i] == len(mine)
    assert (held.all(J.DIMS).sum(1) == [len(s) for s in sets]).all()
    assert not len(held.overlap(np.zeros(0, np.int64), np.zeros(0, np.int64)))
