"""Benchmark decontamination by a generalised suffix automaton (operator 7).

The normalised words of all test items make one automaton. Training texts are
streamed through it and the longest match that ends at each word is tracked: a
word whose match is at least a window long ends a window, and the links from
its state lead to the short items that end there too.

Most words of a text can't be part of a window: only runs in which every pair
of neighbours occurs in some item are streamed, the rest is skipped by numpy.

The items are a given, small set; an automaton holds ``max_item_words`` words
at most, and a larger benchmark makes several, over which the texts are
streamed one after the other. Nulls, empty texts and texts without words have
no hits; items that repeat count by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T

MARKS = "row long, n_words long, hits array<struct<start:int,end:int>>, bytes array<struct<start:int,end:int>>, items array<long>"


class Automaton:
    """A suffix automaton of several sequences of word numbers, and the windows of each."""

    def __init__(self, items: list[tuple[int, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, w)
        # Windows by the state that holds them: the items of each window size.
        self.windows: dict[int, dict[int, set[int]]] = {}
        for item, words in items:
            size = min(window, len(words))
            state, n = 0, 0
            for w in words:
                state, n = self.step(state, n, w)
                if n >= size > 0:
                    at = state
                    while self.length[self.link[at]] >= size:
                        at = self.link[at]
                    self.windows.setdefault(at, {}).setdefault(size, set()).add(item)

    def _state(self, length: int, nexts: dict[int, int], link: int) -> int:
        self.next.append(nexts)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The state for the words of length[p] + 1 in q, taken out of q."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self._split(last, w, self.next[last][w])
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w, self.next[p][w])
        return new

    def step(self, state: int, n: int, w: int) -> tuple[int, int]:
        """The state and length of the longest match after one more word."""
        while state and w not in self.next[state]:
            state = self.link[state]
            n = self.length[state]
        if w in self.next[state]:
            return self.next[state][w], n + 1
        return 0, 0

    def found(self, state: int, n: int) -> Iterator[tuple[int, set[int]]]:
        """(size, items) of every window that ends in a match of n words."""
        while state > 0:
            for size, items in self.windows.get(state, {}).items():
                if size <= n:
                    yield size, items
            state = self.link[state]
            n = min(n, self.length[state])


class Index:
    """An automaton with the hashes of its words, for streaming bytes."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        texts = pa.array([t for _, t in items], pa.string())
        h, row = word_hashes(texts)[:2]
        self.words = np.unique(h)
        number = np.searchsorted(self.words, h)
        per_row = np.split(number, np.cumsum(np.bincount(row, minlength=len(items)))[:-1]) if items else []
        seqs = [(i, w.tolist()) for (i, _), w in zip(items, per_row, strict=True) if len(w)]
        self.automaton = Automaton(seqs, window)
        self.least = min((min(window, len(w)) for _, w in seqs), default=0)
        pairs = [np.array(w[:-1], np.int64) * len(self.words) + np.array(w[1:], np.int64) for _, w in seqs if len(w) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)

    def runs(self, h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """The number of each word (-1: in no item), and the runs that may hold a window."""
        if not self.least or not len(h):
            return np.zeros(0, np.int64), []
        number = np.searchsorted(self.words, h)
        number[number == len(self.words)] = 0
        number = np.where(self.words[number] == h, number, -1)
        pair = number[:-1] * len(self.words) + number[1:]
        ok = (number[:-1] >= 0) & (number[1:] >= 0) & (row[1:] == row[:-1])
        if len(self.pairs):
            at = np.searchsorted(self.pairs, pair)
            at[at == len(self.pairs)] = 0
            ok &= self.pairs[at] == pair
        else:
            ok[:] = False
        known = number >= 0
        joined = np.concatenate([[False], ok])  # word i goes on from word i - 1
        first = np.flatnonzero(known & ~joined)
        last = np.flatnonzero(known & ~np.concatenate([ok, [False]])) + 1
        long = last - first >= self.least
        return number, list(zip(first[long].tolist(), last[long].tolist(), strict=True))

    def mark(self, number: np.ndarray, a: int, b: int) -> tuple[list[tuple[int, int]], set[int]]:
        """The hit spans of words a..b and the items whose windows occur there."""
        auto, state, n, hits, items = self.automaton, 0, 0, [], set()
        for i in range(a, b):
            state, n = auto.step(state, n, int(number[i]))
            for size, which in auto.found(state, n):
                items |= which
                start = i + 1 - size
                while hits and hits[-1][1] >= start:  # words that are already hit
                    start = min(start, hits.pop()[0])
                hits.append((start, i + 1))
        return hits, items


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, start byte in the row, end byte in the row) of every word of lower-cased texts."""
    buf, offs = T.flat(texts)
    s, e, row = T.spans(T.LOWER[buf], offs, T.ALNUM)
    return T.hashes(T.LOWER[buf], s, e), row, s - offs[row], e - offs[row]


def _mark_rows(index: Index, some: pa.RecordBatch) -> pa.RecordBatch:
    """n_words, hits, bytes and items of each row's text."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    h, row, start, end = word_hashes(some.column("text"))
    n_words = np.bincount(row, minlength=some.num_rows)
    base = np.cumsum(n_words) - n_words
    hits: list[list] = [[] for _ in range(some.num_rows)]
    cut: list[list] = [[] for _ in range(some.num_rows)]
    items: list[set] = [set() for _ in range(some.num_rows)]
    number, runs = index.runs(h, row)
    for a, b in runs:
        found, which = index.mark(number, a, b)
        r = int(row[a])
        items[r] |= which
        hits[r] += [{"start": x - int(base[r]), "end": y - int(base[r])} for x, y in found]
        cut[r] += [{"start": int(start[x]), "end": int(end[y - 1])} for x, y in found]
    return pa.record_batch(
        [pa.array(n_words, pa.int64()), pa.array(hits, span), pa.array(cut, span), pa.array([sorted(x) for x in items], pa.list_(pa.int64()))],
        ["n_words", "hits", "bytes", "items"],
    )


def _marks(index: Index, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for some in T.slices(batch):
            got = _mark_rows(index, some)
            yield pa.record_batch([some.column("row"), *got.columns], ["row", *got.schema.names])


def _indexes(benchmark: DataFrame, window: int, max_item_words: int) -> list[Index]:
    """The automata, each of a bounded number of words (or of one longer item)."""
    out, some, size = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("i"), F.col("text").cast("string").alias("t"))
    for r in rows.where("i is not null and t is not null").orderBy("i", "t").toLocalIterator():
        n = r["t"].count(" ") + 1
        if some and size + n > max_item_words:
            out, some, size = [*out, Index(some, window)], [], 0
        some.append((r["i"], r["t"]))
        size += n
    return [*out, Index(some, window)]


def mark(docs: DataFrame, benchmark: DataFrame, window: int = 13, max_item_words: int = 2_000_000) -> DataFrame:
    """Each document with ``n_words``, ``hits`` (spans of hit words), ``hit_bytes`` (the same in
    UTF-8 bytes), ``items`` (ids of items with occurring windows, ascending), ``n_hit``.

    The other columns stay; of clashing names the operator's wins.
    """
    indexes = _indexes(benchmark, window, max_item_words)
    sc = docs.sparkSession.sparkContext
    names = ["n_words", "hits", "hit_bytes", "items", "n_hit"]
    kept = [c for c in docs.columns if c not in names]
    if len(indexes) == 1:
        shared = sc.broadcast(indexes[0])
        kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
        schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", n_words long, hits array<struct<start:int,end:int>>, hit_bytes array<struct<start:int,end:int>>, items array<long>"

        def one_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for some in T.slices(batch):
                    got = _mark_rows(shared.value, some)
                    yield pa.record_batch([some.column(c) for c in kept] + got.columns, [*kept, "n_words", "hits", "hit_bytes", "items"])

        marked = docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(one_pass, schema)
        return marked.withColumn("n_hit", _covered("hits"))
    # Several automata: their spans of a document are brought together by row.
    rows = docs.select(*[F.col(f"`{c}`") for c in kept]).withColumn("row", F.monotonically_increasing_id())
    from .common import Stage

    rows = Stage(docs.sparkSession, "decontamination").write(rows, "rows")
    parts = None
    for index in indexes:
        shared = sc.broadcast(index)
        part = rows.select("row", "text").mapInArrow(lambda b, s=shared: _marks(s.value, b), MARKS)
        parts = part if parts is None else parts.unionByName(part)
    merged = parts.groupBy("row").agg(
        F.first("n_words").alias("n_words"),
        _merged(F.flatten(F.collect_list("hits"))).alias("hits"),
        _merged(F.flatten(F.collect_list("bytes"))).alias("hit_bytes"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return rows.join(merged, "row").drop("row").withColumn("n_hit", _covered("hits"))


def _merged(spans):
    """Sorted spans without overlaps."""
    kind = "array<struct<start:int,end:int>>"
    add = lambda out, x: F.when(
        (F.size(out) > 0) & (F.element_at(out, -1)["end"] >= x["start"]),
        F.concat(
            F.slice(out, 1, F.size(out) - 1),
            F.array(F.struct(F.element_at(out, -1)["start"].alias("start"), F.greatest(F.element_at(out, -1)["end"], x["end"]).alias("end"))),
        ),
    ).otherwise(F.concat(out, F.array(x)))
    return F.aggregate(F.array_sort(spans), F.array().cast(kind), add)


def _covered(spans: str):
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


def contaminated(n_hit, n_words, share: int = 20):
    """Whether a document counts as contaminated: at least one of ``share`` words is hit."""
    return (n_hit > 0) & (share * n_hit >= n_words)


def cut_spans(marked: DataFrame) -> DataFrame:
    """The texts without their hit spans. Offsets are bytes, so the text is cut as bytes."""
    data = F.col("text").cast("binary")
    ends = F.concat(F.array(F.lit(0)), F.transform("hit_bytes", lambda x: x["end"]))
    starts = F.concat(F.transform("hit_bytes", lambda x: x["start"]), F.array(F.octet_length("text")))
    left = F.zip_with(ends, starts, lambda a, b: F.substring(data, a + 1, b - a).cast("string"))
    return marked.withColumn("text", F.when(F.size("hit_bytes") > 0, F.array_join(left, "")).otherwise(F.col("text")))
