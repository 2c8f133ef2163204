import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from gridlake.llm import mixing, phrases, whitening
from gridlake.llm import text as T

DOCS = "doc_id long, text string, lang string, source string"


# ---- phrases --------------------------------------------------------------------------------


def plain_phrases(rows, support, first):
    """The contract, word by word."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= support}
    out = []
    for (lang, g), a in found.items():
        longer = [b for (x, h), b in found.items() if x == lang and len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h)))]
        if any(100 * b >= 50 * a for b in longer):
            continue
        score, cut = min(((1000000 * a * a) // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g)))
        out.append((lang, -score, -a, " ".join(g).encode(), f[lang, g[:cut]], f[lang, g[cut:]], n[lang]))
    result, rank = [], Counter()
    for lang, s, a, g, left, right, total in sorted(out):
        rank[lang] += 1
        if rank[lang] <= first:
            result.append((lang, rank[lang], g.decode(), -a, left, right, total, -s))
    return sorted(result)


def prose(seed, n):
    rng = np.random.default_rng(seed)
    words = ["a", "New", "York", "city", "élan", "Ürgen", "of", "b" * 40, "中文", "x\x0by", "\xa0"]
    signs = [" ", " ", " ", "\t", " ", ", ", ". ", "\n", "!"]
    rows = []
    for i in range(n):
        k = int(rng.integers(0, 60))
        rows.append(("".join(words[rng.integers(len(words))] + signs[rng.integers(len(signs))] for _ in range(k)), ["en", "de", None, "und"][i % 4]))
    return rows + [("new york city " * 50, "en"), (None, "en"), ("", None), ("...!!", "fr"), ("the same row of words " * 3, "de")] * 2


@pytest.mark.parametrize("seed,shard", [(1, 1 << 20), (2, 40)])
def test_phrases_equal_a_plain_count(spark, seed, shard, monkeypatch):
    monkeypatch.setattr(phrases, "LEAST_PARTS", 7)
    monkeypatch.setattr(T, "SLICE_BYTES", 200)
    rows = prose(seed, 120)
    docs = spark.createDataFrame([(i, t, lang, "s") for i, (t, lang) in enumerate(rows)], DOCS).repartition(3)
    for support, first in ((10, 2000), (3, 5)):
        got = phrases.collocations(docs, support=support, first=first, shard_words=shard)
        assert sorted(map(tuple, got.collect())) == plain_phrases(rows, support, first)


def test_phrases_of_odd_and_no_documents(spark, odd_docs, no_docs):
    rows = [(r.text, r.lang) for r in odd_docs.collect()]
    got = phrases.collocations(odd_docs, support=2).collect()
    assert sorted(map(tuple, got)) == plain_phrases(rows, 2, 2000)
    assert phrases.collocations(no_docs).count() == 0


@pytest.mark.parametrize("in_task", [True, False])
def test_a_clash_of_keys_takes_another_seed(spark, monkeypatch, in_task):
    docs = spark.createDataFrame([(1, "one two three", "en", "s")], DOCS)
    real = phrases.words

    def clashing(docs, seed):
        found = real(docs, seed)
        if seed > 1:
            return found
        return found.withColumn("key", phrases.F.raise_error(phrases.F.lit("Collision"))) if in_task else found.withColumn("key", phrases.F.lit(5).cast("long"))

    monkeypatch.setattr(phrases, "words", clashing)
    found, seed = phrases.counted_words(phrases.Stage(spark, "t"), docs)
    assert seed > 1 and found.select("key").distinct().count() == 3


def test_keys_differ_where_sums_of_powers_do_not():
    a = "a"
    for _ in range(11):  # Thue-Morse: its complement has the same sum of powers for every base modulo 2**64
        a += a.translate(str.maketrans("ab", "ba"))
    words = [a.encode(), a.translate(str.maketrans("ab", "ba")).encode(), b"x", b"x\0", b"12345678", b"123456789", b""]
    buf = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    keys = T.word_keys(buf, ends - [len(w) for w in words], ends, 1)
    assert len(set(keys.tolist())) == len(words)
    again = np.frombuffer(b"zz" + words[5] + b"y", np.uint8)
    assert T.word_keys(again, np.array([2]), np.array([11]), 1)[0] == keys[5]


def test_large_counts_score_exactly(spark):
    a, left, right = 3_000_000_007, 9_999_999_967, 8_000_000_011
    row = spark.range(1).select(*[phrases.F.lit(x).cast("long").alias(n) for n, x in (("a", a), ("l", left), ("r", right))])
    got = row.select(phrases._score(phrases.F.col("a"), phrases.F.col("l"), phrases.F.col("r"))).first()[0]
    assert got == 1000000 * a * a // (left * right)


# ---- whitening ------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64])
def test_eigenpairs_equal_a_library(n):
    rng = np.random.default_rng(n)
    a = rng.normal(size=(n + 20, n))
    c = a.T @ a
    k = min(4, n)
    values, vectors = whitening.eigenpairs(c, k)
    want, basis = np.linalg.eigh(c)
    assert np.allclose(values, want[::-1][:k], rtol=1e-13)
    assert np.abs(np.abs((vectors * basis[:, ::-1][:, :k]).sum(0)) - 1).max() < 1e-12


def test_eigenpairs_of_clusters_and_of_nothing():
    q = np.linalg.qr(np.random.default_rng(0).normal(size=(30, 30)))[0]
    c = q @ np.diag([9, 9 - 1e-10, 9, 4] + [1.0] * 26) @ q.T
    values, v = whitening.eigenpairs((c + c.T) / 2, 4)
    assert np.abs(v.T @ v - np.eye(4)).max() < 1e-13 and np.abs(c @ v - v * values).max() < 1e-12
    assert whitening.eigenpairs(np.zeros((3, 3)), 2)[0].tolist() == [0, 0]
    values, v = whitening.eigenpairs(np.diag([1.0, 5, 5, 2]), 3)
    assert np.allclose(values, [5, 5, 2]) and np.abs(v.T @ v - np.eye(3)).max() < 1e-13


def vectors(seed, n=300, dim=6):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)) * [3, 1, 0.5, 2, 0.1, 0.7] + [0, 5, 0, -2, 100, 0]
    rows = [(i, x.astype(np.float32).tolist()) for i, x in enumerate(v)]
    rows += [(1000 + i, rows[0][1]) for i in range(n // 2)]  # a third are copies
    return rows + [(2000, None), (2001, [1.0, None] * 3), (2002, [float("nan")] * dim), (2003, [float("inf")] * dim), (2004, []), (2005, [1.0]), (None, rows[1][1]), rows[2], (2006, [-0.0] * dim)]


def test_whitening_equals_a_library(spark, monkeypatch):
    monkeypatch.setattr(whitening, "ROWS", 50)
    rows = vectors(1)
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, n int, x string").repartition(5)
    got = whitening.whiten(df).collect()
    good = [(i, np.floor(np.array(v, np.float64) * 256).astype(np.int64)) for i, v in rows if v and len(v) == 6 and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x.tolist()) for _, x in good}))
    n, s = len(fit), fit.sum(0)
    centred = fit - s / n
    cov = centred.T @ centred / n
    w, basis = np.linalg.eigh(cov)
    assert len(got) == 4 * len(good) and {r.n for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.component), []).append(r)
    signs = {}
    for i, x in good:
        for k in range(1, 5):
            r = by[i, k][0]
            want = (x - s / n) @ basis[:, -k] / np.sqrt(w[-k])
            sign = signs.setdefault(k, np.sign(want * r.whitened))
            assert abs(r.whitened - sign * want) < 1e-9
            assert r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s, strict=True))
            assert abs(r.explained - w[-k] / np.trace(cov)) < 1e-9 and r.identity_error < 1e-9
    assert len({r.identity_error for r in got}) == 1


def test_sums_of_any_size_are_exact():
    x = np.array([[1 << 60, -(1 << 59)], [-(1 << 60), 3], [7, 1 << 58]])
    want = [[sum(int(a[i]) * int(a[j]) for a in x) for j in range(2)] for i in range(2)]
    assert whitening.products(x) == want
    for v in (want[0][0], want[0][1], -5, 0):
        limbs = whitening._limbs(v)
        assert whitening._total({f"l{k}": b for k, b in enumerate(limbs)}) == v and all(abs(b) < 1 << 63 for b in limbs)
    assert whitening.Whitener(3, [5, 5], None, None, 1.0).deviations(np.array([[1 << 60, 0], [1, 2]])) == [None, 4 + 1]


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<double>"
    for rows in ([], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        got = whitening.whiten(spark.createDataFrame(rows, schema))
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and got.count() == 0
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], schema)).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 5.0]), (3, [0.0, 1.0])], schema)).collect()
    assert len(huge) and all(np.isfinite(r.whitened) for r in huge) and huge[0].deviation is None


# ---- mixing ---------------------------------------------------------------------------------


def plain_targets(sizes):
    """Shares of the sources by rounds of resharing, in fractions."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full = set()
    while True:
        room = Fraction(sum(sizes.values())) - sum(3 * sizes[s] for s in full)
        shares = sum(weight[s] for s in order if s not in full)
        target = {s: Fraction(3 * sizes[s]) if s in full else weight[s] * room / (shares or 1) for s in order}
        more = {s for s in order if target[s] > 3 * sizes[s]}
        if not more:
            return target
        full |= more


def corpus(seed, n=3000):
    rng = np.random.default_rng(seed)
    names = ["hot"] * 10 + [f"s{i}" for i in range(12)] + ["Z", "é", None]
    rows = [(i, "w " * int(min(3000, rng.lognormal(4, 1.2))), "en", names[rng.integers(len(names))]) for i in range(n)]
    return rows + [(n + i, "tiny", "en", "small") for i in range(5)] + [(9000, None, None, "nothing"), (9001, " \t", "en", "nothing"), (None, "a b c", "en", None), (None, "a b c", "en", None), (7, rows[7][1], "en", rows[7][3])]


def test_mix_meets_its_targets(spark):
    rows = corpus(1)
    docs = spark.createDataFrame([(*r, 5, 1.0) for r in rows], DOCS + ", size long, target double").repartition(4)
    got = mixing.mix(docs, ["doc_id", "source"]).select("doc.*", "size", "source_size", mixing.F.col("target").alias("t"), "copies", "taken").collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    want = plain_targets(dict(sizes))
    taken, least = Counter(), {}
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.t - float(want[r.source])) < 1e-6
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[r.source] += r.taken
        if r.size:
            least.setdefault(r.source, []).append(r.size)
    for s, t in want.items():
        assert -1e-6 <= float(t) - taken[s] <= max(50, 0.002 * float(t))
    again = mixing.mix(docs.repartition(7), ["doc_id", "source"]).select("doc.*", "copies").collect()
    assert Counter(map(tuple, again)) == Counter((r.doc_id, r.source, r.copies) for r in got)
    mixed = Counter(r.doc_id for r in mixing.mixture(docs).collect())
    assert mixed == Counter({i: n for i, n in ((i, sum(r.copies for r in got if r.doc_id == i)) for i in {r.doc_id for r in got}) if n})


def test_longer_documents_are_preferred_and_chances_are_kept(spark):
    """Over many draws a document's mean number of copies is its expected number."""
    rows = [(i, f"{i % 7} " * (1 << (i % 5)), "en", "ab"[i % 2]) for i in range(4000)]
    got = mixing.mix(spark.createDataFrame(rows, DOCS), ["doc_id", "source"]).select("doc.source", "size", "copies").collect()
    for source in "ab":
        means = [np.mean([r.copies for r in got if r.source == source and r.size == 1 << k]) for k in range(5)]
        steps = [m / (k + 2) for k, m in enumerate(means)]  # a grade is the number of binary digits and one
        assert max(steps) / min(steps) < 1.15


def test_mix_of_odd_and_no_documents(spark, odd_docs, no_docs):
    got = mixing.mix(odd_docs, ["doc_id"]).select("doc.doc_id", "size", "taken").collect()
    assert len(got) == odd_docs.count() and all(r.taken <= 3 * r.size for r in got)
    assert mixing.mix(no_docs).count() == 0 and mixing.mixture(no_docs).columns == no_docs.columns
    one = spark.createDataFrame([(1, "a b c", "en", None)], DOCS)
    assert [(r.size, r.target, r.taken) for r in mixing.mix(one, ["doc_id"]).collect()] == [(3, 3.0, 3)]
