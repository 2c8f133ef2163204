"""Best-fit packing of documents into sequences (operator 3).

Tokenised documents are cut into pieces of at most the sequence length, and
the pieces are counted by length. That histogram has no more entries than the
sequence length, whatever the corpus, and goes to the driver, which solves the
configuration linear program over it: minimise the number of sequences, a
configuration being a multiset of lengths that fits one sequence.

* Multiplicative weights: each length has a weight; a knapsack dynamic
  program over the capacity prices the best configuration under the weights;
  that configuration is used as far as its scarcest length allows, and the
  weights of the lengths it covers shrink.
* Rounding: every configuration is taken a whole number of times, never more
  often than pieces are left. What remains is solved again, and what can't be
  rounded any more goes, longest first, to the sequence it fits best. Of the
  roundings (after none, one, two ... solutions) the one with the fewest
  sequences counts, so a plan is never worse than best-fit decreasing alone.

Each piece then finds its place from its rank among the pieces of its length.
Ranks are sums of counts by task and length, so no length is gathered in one
task.

Null or empty texts hold the end id alone; rows that repeat are packed as
often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .common import Stage, texts
from .tokens import ENCODE_BYTES, encoder

PIECES = "part int, doc_id long, piece int, start long, length long, ids_crc32 long, local long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False) -> DataFrame:
    """The pieces of every document, with a number among the task's pieces of its length."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for some in T.slices(batch, budget=ENCODE_BYTES, trim=False):
                got, offs = enc.encode(some.column("text"))
                size = np.diff(offs) + 1
                n = -(-size // capacity)
                row = np.repeat(np.arange(len(size)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(capacity, size[row] - start)
                # The task's pieces of each length so far, counting up.
                order = np.argsort(length, kind="stable")
                run = length[order]
                first = np.searchsorted(run, run)
                local = np.empty(len(row), np.int64)
                local[order] = np.arange(len(row)) - first + seen[run]
                seen += np.bincount(length, minlength=capacity + 1)
                data = []
                with_end = np.insert(got, offs[1:], end_id).astype("<u4")
                for a, k in zip((offs[row] + row + start).tolist(), length.tolist(), strict=True):
                    data.append(with_end[a : a + k].tobytes())
                cols = [
                    pa.array(np.full(len(row), part), pa.int32()),
                    some.column("doc_id").take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array([zlib.crc32(x) for x in data], pa.int64()),
                    pa.array(local, pa.int64()),
                ]
                names = ["part", "doc_id", "piece", "start", "length", "ids_crc32", "local"]
                yield pa.record_batch(cols + [pa.array(data, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    return texts(docs).mapInArrow(cut, PIECES + ", ids binary" * with_ids)


def best_configuration(price: np.ndarray) -> list[int]:
    """The lengths (with repetition) of the dearest configuration; price[l] <= 0: no piece of length l."""
    capacity = len(price) - 1
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        worth = best[c - 1 :: -1] + price[1 : c + 1]
        k = int(worth.argmax())
        if worth[k] > best[c - 1]:
            best[c], last[c] = worth[k], k + 1
        else:
            best[c] = best[c - 1]  # this much is enough without the last unit
    out, c = [], capacity
    while c > 0:
        if last[c]:
            out.append(int(last[c]))
            c -= int(last[c])
        else:
            c -= 1
    return out


def configuration_lp(count: np.ndarray, rounds: int, rate: float = 0.5) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """A fractional solution: (lengths, copies, times) of each configuration, scaled to cover every count."""
    capacity = len(count) - 1
    need = count > 0
    weight = np.where(need, np.arange(capacity + 1) / capacity, -1.0)
    done = np.zeros(capacity + 1)
    found: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        config = best_configuration(weight)
        if not config:
            break
        lengths, copies = np.unique(config, return_counts=True)
        times = float((count[lengths] / copies).min())
        key = tuple(config)
        found[key] = found.get(key, 0.0) + times
        part = times * copies / count[lengths]
        done[lengths] += part
        weight[lengths] *= np.exp(-rate * part)
        if done[need].min() >= 1:
            break
    out = []
    for config, times in found.items():
        lengths, copies = np.unique(config, return_counts=True)
        # No piece is needed more than once: scale by what covers least here.
        out.append((lengths, copies, times / max(1.0, float(done[lengths].min()))))
    return sorted(out, key=lambda x: -x[2])


def best_fit(count: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(lengths, copies, times) of best-fit decreasing: each piece, longest first, goes where the least room is left.

    Sequences filled alike are one entry with a number of times, so the work
    depends on the lengths, not on the number of pieces.
    """
    capacity = len(count) - 1
    alike: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]  # by room: contents and times
    rooms = np.zeros(capacity + 1, bool)
    for length in np.flatnonzero(count)[::-1].tolist():
        c = int(count[length])
        while c:
            room = length + int(rooms[length:].argmax())
            if not rooms[room]:  # none has room: new ones, each with as many of these as fit
                each = min(capacity // length, c)
                room = capacity - each * length
                alike[room].append(((length,) * each, c // each))
                c -= c // each * each
            else:
                inside, times = alike[room].pop()
                now = min(c, times)
                if now < times:
                    alike[room].append((inside, times - now))
                rooms[room] = bool(alike[room])
                room -= length
                alike[room].append(((*inside, length), now))
                c -= now
            rooms[room] = True
    return [(*np.unique(inside, return_counts=True), times) for some in alike for inside, times in some]


def pack_histogram(count: np.ndarray, rounds: int = 400) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(lengths, copies, times): configurations that use count[l] pieces of each length l exactly."""
    left = count.astype(np.int64).copy()
    capacity = len(left) - 1
    out = []

    def use(lengths: np.ndarray, copies: np.ndarray, times: int) -> None:
        if times > 0:
            out.append((lengths, copies, times))
            left[lengths] -= times * copies

    use(np.array([capacity]), np.array([1]), int(left[capacity]))
    whole = lambda some: sum(times for _, _, times in some)
    best = out + best_fit(left)
    while left.any():
        before = left.sum()
        for lengths, copies, times in configuration_lp(left, rounds):
            use(lengths, copies, int(min(times + 1e-9, (left[lengths] // copies).min())))
        now = out + best_fit(left)
        if whole(now) < whole(best):
            best = now
        if left.sum() > 0.7 * before:
            break
    return best


def places(packed: list[tuple[np.ndarray, np.ndarray, int]]) -> dict[str, np.ndarray]:
    """For each length, in order of rank: from which rank on which sequences hold its pieces."""
    rows, sequence, used = [], 0, {}
    for lengths, copies, times in packed:
        at = 0
        for n, c in zip(lengths.tolist(), copies.tolist(), strict=True):
            rows.append((n, used.get(n, 0), sequence, c, at))
            used[n] = used.get(n, 0) + c * times
            at += n * c
        sequence += times
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "copies", "at"), a.T, strict=True))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Place every piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    stage = Stage(docs.sparkSession, "packing")
    cut = stage.write(pieces(docs, tokenizer, end_id, capacity, with_ids), "pieces")
    by_task = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    count = np.zeros(capacity + 1, np.int64)
    for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        count[r["length"]] = r["n"]
    plan = docs.sparkSession.sparkContext.broadcast(places(pack_histogram(count)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = by_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = cut.join(first, ["part", "length"]).withColumn("rank", F.col("first") + F.col("local"))
    out = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        key = p["length"] << 48 | p["rank"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(key, length << 48 | rank, side="right") - 1
            nth = rank - p["rank"][k]
            yield pa.record_batch(
                [batch.column(c) for c in out]
                + [
                    pa.array(p["sequence"][k] + nth // p["copies"][k], pa.int64()),
                    pa.array(p["at"][k] + nth % p["copies"][k] * length, pa.int64()),
                ],
                [*out, "sequence_id", "offset"],
            )

    return ranked.select(*out, "rank").mapInArrow(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
        + ", sequence_id long, offset long",
    )
