"""Phrase collocation mining by SON partitioning (operator 11).

Phrases are one to ``LONGEST`` words in a row inside a piece of a text (between
the signs that cut it). A phrase is frequent in a language with ``SUPPORT``
occurrences. The corpus is dealt into shards of about ``SHARD_WORDS`` words:

1. every shard is mined completely: all its phrases are counted, and those that
   reach the local support, lowered in proportion to the shard's words, are
   locally frequent. A phrase that no shard finds locally frequent has fewer
   occurrences than ``SUPPORT``, as all shards together have all words;
2. the locally frequent phrases of all shards together are the candidates;
3. every candidate is counted exactly, as the sum of its counts in all shards.

A shard of a large corpus is so small that its local support is one; then
all it counts is locally frequent. So a shard sends all its counts once, with its local support,
and the task that gathers a part of the phrases unites the candidates and sums
their counts; nothing is mined a second time. No shard sends a phrase twice, so
a very common one is a row per shard at most.

A word's key is a 64-bit number made from its language and bytes. That no two
words of the corpus have one key is checked, in the shards by a second key and
over all shards by comparing the words themselves; if two had, all would be done
again with another seed. A phrase is the sequence of its words' keys, so counts
are exact.

Scores are whole-number divisions of decimals. Null texts are empty, null
languages ``und``; rows that repeat count again; an empty table has no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .common import Stage, ship

SUPPORT = 10
LONGEST = 3
FIRST = 2000
COVERED = 50  # percent of a phrase's occurrences that lie in a longer candidate
SHARD_WORDS = 1 << 21
PART_WORDS = 1 << 22  # words of the corpus for one part of the phrases
LEAST_PARTS = 24
SALTS = 64
SLICES = 8

_CUT = T.table((0x0A, 0x0D)) | np.isin(np.arange(256), list(b".,;:!?"))
_WORD = ~(_CUT | T.table((0x20, 0x20), (0x09, 0x09)))


class Collision(RuntimeError):
    """Two different words have one key."""


def _rows(docs: DataFrame) -> DataFrame:
    ship(docs.sparkSession)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text")).where("text is not null and text <> ''")


class _Slice:
    """The words of some texts: keys (of language and word), and for each word its place in a run of one piece."""

    def __init__(self, some: pa.RecordBatch, seed: int):
        raw, self.offs = T.flat(some.column("text"))
        self.buf = T.LOWER[raw]
        self.s, self.e, self.row = T.spans(self.buf, self.offs, _WORD)
        self.langs = some.column("lang")
        names, at = T.flat(self.langs)
        of_lang = T.word_keys(names, at[:-1], at[1:], seed + 1)
        self.keys = T.mix(T.word_keys(self.buf, self.s, self.e, seed) ^ of_lang[self.row])
        # A word goes on from the one before if no cutting sign and no border of a text lies between.
        cuts = np.concatenate([[0], np.cumsum(_CUT[self.buf])])
        piece = cuts[self.s]
        self.goes_on = np.zeros(len(self.s), bool)
        self.goes_on[1:] = (piece[1:] == piece[:-1]) & (self.row[1:] == self.row[:-1])


def _slices(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[_Slice]:
    for batch in batches:
        for some in T.slices(batch):
            x = _Slice(some, seed)
            if len(x.keys):
                yield x


def _shards(batches: Iterator[pa.RecordBatch], seed: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The keys of the words of about ``most`` words of texts, and whether each goes on from the one before."""
    held, n = [], 0
    for x in _slices(batches, seed):
        held.append((x.keys, x.goes_on))
        n += len(x.keys)
        if n >= most:
            yield tuple(map(np.concatenate, zip(*held, strict=True)))
            held, n = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held, strict=True)))


class _Words:
    """The distinct words of some slices: key, check, count, language and the word itself."""

    def __init__(self) -> None:
        self.keys, self.checks, self.counts, self.langs, self.words = [], [], [], [], []

    def add(self, x: _Slice, seed: int) -> None:
        check = T.word_keys(x.buf, x.s, x.e, seed + 2)
        first, number = T.distinct(x.keys)
        if (check != check[first][number]).any():
            raise Collision(seed)
        self.keys.append(x.keys[first])
        self.checks.append(check[first])
        self.counts.append(np.bincount(number, minlength=len(first)))
        self.langs.append(x.langs.take(pa.array(x.row[first])))
        self.words.append(pa.array(T.strings(x.buf, x.s[first], x.e[first]), pa.string()))

    def rows(self, seed: int) -> pa.RecordBatch:
        keys, checks, counts = map(np.concatenate, (self.keys, self.checks, self.counts))
        first, number = T.distinct(keys)
        if (checks != checks[first][number]).any():
            raise Collision(seed)
        at = pa.array(first)
        total = np.zeros(len(first), np.int64)
        np.add.at(total, number, counts)
        columns = [pa.array(keys[first].view(np.int64)), pa.concat_arrays(self.langs).take(at), pa.concat_arrays(self.words).take(at), pa.array(total)]
        return pa.record_batch(columns, ["key", "lang", "word", "c"])


def words(docs: DataFrame, seed: int) -> DataFrame:
    """key, lang, word, c: the words of each ``SLICES`` slices of texts with their counts there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Words()
        for x in _slices(batches, seed):
            held.add(x, seed)
            if len(held.keys) == SLICES:
                yield held.rows(seed)
                held = _Words()
        if held.keys:
            yield held.rows(seed)

    return _rows(docs).mapInArrow(run, "key long, lang string, word string, c long")


def counted_words(stage: Stage, docs: DataFrame) -> tuple[DataFrame, int]:
    """(key, lang, word, f) of all words, and the seed under which their keys differ."""
    seed = 1
    while True:
        w = F.struct("lang", "word")
        try:
            found = words(docs, seed).groupBy("key").agg(F.sum("c").alias("f"), F.min(w).alias("w"), F.max(w).alias("other"))
            found = stage.write(found, f"words-{seed}")
            clash = found.where("w <> other").limit(1).count()
        except Exception as e:  # raised in a task, so it comes as Spark's error
            if Collision.__name__ not in str(e):
                raise
            clash = 1
        if not clash:
            return found.select("key", "w.lang", "w.word", "f"), seed
        seed += 8


def grouped(ids: np.ndarray, values: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal rows of ``ids`` (numbers below ``values``) together, and the starts of the groups."""
    n, k = ids.shape
    bits = max(1, int(values - 1).bit_length()) if values else 1
    if bits * k <= 63:
        key = ids[:, 0].astype(np.int64)
        for j in range(1, k):
            key = key << bits | ids[:, j]
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = key[1:] != key[:-1]
    else:
        order = np.lexsort(ids.T[::-1])
        some = ids[order]
        new = (some[1:] != some[:-1]).any(1)
    return order, np.flatnonzero(np.concatenate([[True], new])) if n else np.zeros(0, np.int64)


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers from 0 on: the bytes of each (1, 2, 4 or 8), then the numbers, compressed."""
    size = next(b for b in (1, 2, 4, 8) if b == 8 or int(x.max(initial=0)) < 1 << 8 * b)
    body = np.ascontiguousarray(x).astype(f"<u{size}").tobytes()
    return bytes([size]) + len(body).to_bytes(8, "little") + pa.compress(body, "zstd", asbytes=True)


def _unpacked(b: bytes) -> np.ndarray:
    body = pa.decompress(b[9:], int.from_bytes(b[1:9], "little"), "zstd", asbytes=True)
    return np.frombuffer(body, f"<u{b[0]}")


_BLOCK = "part int, k int, support long, words binary, ids binary, counts binary"


def blocks(docs: DataFrame, seed: int, total: int, parts: int, support: int = SUPPORT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The counts of all phrases of two words or more in each shard.

    A row holds those of one length and part: the keys of their words, the words'
    places among these keys, word by word, and the counts; ``support`` is the local support.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, goes_on in _shards(batches, seed, shard_words):
            first, number = T.distinct(keys)
            vocabulary = keys[first]
            number = number.astype(np.int32)
            local = max(1, -(-support * len(keys) // max(1, total)))
            whole = np.ones(len(keys), bool)
            for k in range(2, LONGEST + 1):
                # k words end here if k - 1 words end at the word before, and this one goes on from it.
                whole[1:] = whole[:-1] & goes_on[1:]
                whole[0] = False
                last = np.flatnonzero(whole)
                if not len(last):
                    continue
                ids = np.stack([number[last - (k - 1 - j)] for j in range(k)], 1)
                order, start = grouped(ids, len(vocabulary))
                counts = np.diff(np.append(start, len(order)))
                ids = ids[order[start]]
                h = vocabulary[ids[:, 0]]
                for j in range(1, k):
                    h = T.mix(h) ^ vocabulary[ids[:, j]]
                part = (T.mix(h) % np.uint64(parts)).astype(np.int32)
                by = np.argsort(part, kind="stable")
                edge = np.flatnonzero(np.concatenate([[True], part[by][1:] != part[by][:-1], [True]]))
                out = []
                for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    mine = by[a:b]
                    used, place = np.unique(ids[mine], return_inverse=True)
                    columns = place.reshape(len(mine), k).T  # the phrases are in order, so a column compresses well
                    out.append((int(part[mine[0]]), k, local, vocabulary[used].tobytes(), _packed(columns), _packed(counts[mine])))
                for a in range(0, len(out), 64):
                    yield pa.record_batch(
                        [pa.array(c, t) for c, t in zip(zip(*out[a : a + 64], strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                        ["part", "k", "support", "words", "ids", "counts"],
                    )
            T.release()

    return _rows(docs).mapInArrow(run, _BLOCK)


def _gathered(support: int):
    """Candidates (phrases that some shard finds locally frequent) of one part and length, with their exact counts."""

    def run(table: pa.Table) -> pa.Table:
        k = table.column("k")[0].as_py()
        vocabularies = [np.frombuffer(b, np.uint64) for b in table.column("words").to_pylist()]
        vocabulary, place = np.unique(np.concatenate(vocabularies), return_inverse=True)
        ids, counts, at = [], [], 0
        frequent = []
        for own, b, c, local in zip(vocabularies, *[table.column(x).to_pylist() for x in ("ids", "counts", "support")], strict=True):
            mine = place[at : at + len(own)].astype(np.int32)
            at += len(own)
            ids.append(mine[_unpacked(b)].reshape(k, -1).T)
            counts.append(_unpacked(c).astype(np.int64))
            frequent.append(counts[-1] >= local)
        ids, counts, frequent = np.concatenate(ids), np.concatenate(counts), np.concatenate(frequent)
        order, start = grouped(ids, len(vocabulary))
        candidate = np.logical_or.reduceat(frequent[order], start)
        f = np.add.reduceat(counts[order], start)
        keep = np.flatnonzero(candidate & (f >= support))
        w = vocabulary[ids[order[start[keep]]]].view(np.int64)
        none = pa.nulls(len(keep), pa.int64())
        return pa.table([pa.array(np.ascontiguousarray(w[:, j])) if j < k else none for j in range(LONGEST)] + [pa.array(f[keep])], names=["k1", "k2", "k3", "f"])

    return run


def frequent_phrases(docs: DataFrame, stage: Stage, support: int = SUPPORT, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """All words (key, lang, word, f), and the frequent phrases of two words or more as keys of words: k1, k2, k3 (null in pairs), f."""
    vocabulary, seed = counted_words(stage, docs)
    total = vocabulary.agg(F.sum("f")).first()[0] or 0
    parts = max(LEAST_PARTS, -(-total // PART_WORDS))
    found = blocks(docs, seed, total, parts, support, shard_words).groupBy("part", "k").applyInArrow(_gathered(support), "k1 long, k2 long, k3 long, f long")
    return vocabulary, stage.write(found, "phrases")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (left right)), exactly."""
    wide = [x.cast("decimal(16,0)") for x in (a, left, right)]
    top = (F.lit(1000000).cast("decimal(7,0)") * (wide[0] * wide[0])).cast("decimal(38,0)")
    return F.call_function("div", top, (wide[1] * wide[2]).cast("decimal(38,0)"))


def collocations(docs: DataFrame, support: int = SUPPORT, first: int | None = FIRST, shard_words: int = SHARD_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``first`` phrases of each language (None: all)."""
    stage = Stage(docs.sparkSession, "phrases")
    vocabulary, found = frequent_phrases(docs, stage, support, shard_words)
    common = stage.write(vocabulary.where(F.col("f") >= support), "common")
    totals = vocabulary.groupBy("lang").agg(F.sum("f").alias("n"))
    pairs, triples = found.where("k3 is null").drop("k3"), found.where("k3 is not null")
    named = lambda i: common.select(F.col("key").alias(f"k{i}"), F.col("word").alias(f"w{i}"), F.col("f").alias(f"f{i}"), *([F.col("lang")] if i == 1 else []))
    two = pairs.join(named(1), "k1").join(named(2), "k2")
    two = two.select("k1", "k2", "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("f").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"))
    covers = triples.select("k1", "k2", "f").unionByName(triples.select(F.col("k2").alias("k1"), F.col("k3").alias("k2"), "f"))
    longer = covers.groupBy("k1", "k2").agg(F.max("f").alias("longer"))
    two = two.join(longer, ["k1", "k2"], "left").where(F.coalesce(100 * F.col("longer") < COVERED * F.col("a"), F.lit(True)))
    two = two.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r"))).select("lang", "phrase", "a", "l", "r", "score")
    ahead = pairs.select("k1", "k2", F.col("f").alias("f12"))
    behind = pairs.select(F.col("k1").alias("k2"), F.col("k2").alias("k3"), F.col("f").alias("f23"))
    three = triples.join(ahead, ["k1", "k2"]).join(behind, ["k2", "k3"]).join(named(1), "k1").join(named(2), "k2").join(named(3), "k3")
    cut1, cut2 = _score(F.col("f"), F.col("f1"), F.col("f23")), _score(F.col("f"), F.col("f12"), F.col("f3"))
    early = cut1 <= cut2
    three = three.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("f").alias("a"),
        F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.when(early, cut1).otherwise(cut2).alias("score"),
    )
    rows = stage.write(two.unionByName(three), "scored")
    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    if first is not None:  # what isn't among the first of a part of a language isn't among its first
        salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
        rows = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= first).drop("salt", "rank")
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    if first is not None:
        rows = rows.where(F.col("rank") <= first)
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
