"""N-gram Jaccard join with count-vector R-trees (operator 4).

A document is the set of its word shingles. Shingles are hashed into groups,
and a document is a point whose coordinates are its counts by group. Two sets
share at most the sum, over the groups, of the smaller count; the same bound
holds for a point and a box of points, which is what the R-tree prunes by.

1. Cells. Documents of a size class are cut into more groups than a linked pair
   can have differences, so some group holds the same shingles in both
   (pigeonhole). A group with a checksum of its shingles is a cell; only
   documents that meet in a cell can be linked. Of the groups that agree, each
   one more than that lets each document leave one out, if all go by one order:
   the last by that order stays in both. There are as many groups more as a
   document is likely to have with one shingle or none (or, at lower
   similarities, with none), and so many with the fewest shingles are left out,
   which unlike documents share. And there are a few more for lines that many
   documents have: of the cells with OFTEN documents or more, so many of the most
   frequent ones are left out.
2. Stars. Each cell links its members to its smallest id. That is a grouped
   minimum and a join, so a group of copies of any size is no bottleneck. The
   pairs that pass the bound are verified on the shingles themselves, and the
   components of the links are found.
3. The rest. A family is a smallest id with the members of all its cells, so
   documents that share many cells with the same smallest id meet once, not once
   in each. It is told from the pairs of a member and a smallest id that the stars
   need anyway, not from the cells, of which there are many more. Families
   whose members are still in different components are gathered: an R-tree over DIMS
   groups joins the members of different components; what passes is held against
   the whole points, which have a group for one or two shingles, so that hardly
   any pair below the similarity is left. What is left is verified, and the components
   of all links are the result. Large families are dealt out in tiles, so that none is
   gathered in one task.

Texts are dealt by id once, into the files of a bucketed table, so the
verifications bring the few pairs to the texts and don't deal all texts anew.

Two rounds of stars (smallest, then largest id) leave few pairs to step 3, and
step 3 leaves none out, so the components are those of all links.

Documents with fewer words than a shingle have their whole sequence as the one
shingle; null, empty and blank texts have none, and no links. Rows that repeat
an id are taken as one document if their texts agree; otherwise each text's
links count for the id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .common import Stage, texts
from .components import components

DIMS = 128  # groups of a point at least, and those of the R-tree; a power of two
GROWTH = 1.25
LEAF = 16
TILE = 2048  # members of a family in one tile of the last step
TILE_BYTES = 8 << 20  # and bytes of their points
PAIRS = 1 << 13  # of a query and a box that are bounded at once
PASSES = 3  # parts in which the cells are dealt, one after the other, so that less is on disk at once
PART = 256  # links of a centre verified in one task
OFTEN = 16  # documents of a cell that may be left out
CLASS = 15  # the bits of a cell's key that tell a document's classes apart
_A, _B = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def shingles(texts: pa.Array, words: int, keep: np.ndarray = T.NOT_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the sorted distinct shingles of text i are hashes[offsets[i]:offsets[i + 1]]."""
    buf, offs = T.flat(texts)
    buf = T.LOWER[buf]
    s, e, row = T.spans(buf, offs, keep)
    h = T.hashes(buf, s, e)
    rows = len(offs) - 1
    n = np.bincount(row, minlength=rows)
    # The shingle at a word is made of it and the next ones, as far as they go.
    out = T.mix(h * _A)
    for k in range(1, words):
        inside = np.zeros(len(h), bool)
        inside[: max(0, len(h) - k)] = row[k:] == row[: max(0, len(h) - k)]
        out[inside] = T.mix(out[inside] * _A + h[np.flatnonzero(inside) + k] * _B + np.uint64(k))
    place = np.arange(len(h)) - (np.cumsum(n) - n)[row]
    whole = (place <= n[row] - words) | (place == 0)
    out, row = out[whole], row[whole]
    cuts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        out[a:b].sort()
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    return out[new], np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=rows))])


def _spare(differ: int, size: int) -> int:
    """The least number of spare groups that covers those with one shingle or none which a set of
    this size has (by Poisson's law, with two deviations); if no number does, those with none."""
    for most in (1, 0):
        for spare in range(1, size if differ else 0):
            groups = differ + 1 + spare
            mean = size / groups
            weak = groups * math.exp(-mean) * (1 + most * mean)
            if spare >= weak + 2 * math.sqrt(weak):
                return spare
            if mean < 1:
                break
    return 0


class Classes:
    """Size classes: linked sets of any two sizes meet in the class of the larger one."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.low = np.array([1], np.int64)

    def grow(self, size: int) -> None:
        if size * self.den // self.num + 1 < self.low[-1]:
            return
        low = self.low.tolist()
        while low[-1] <= size * self.den // self.num + 1:
            low.append(max(low[-1] + 1, int(low[-1] * GROWTH)))
        self.low = np.array(low, np.int64)
        top = self.low[1:] - 1
        differ = 2 * top * (self.den - self.num) // (self.den + self.num)
        self.leave = np.where(self.low[:-1] < 15, 0, 1 + self.low[:-1] // 64)  # frequent cells left out at most
        # For the smallest sets that meet partners here; if no number covers theirs, for the smallest of the class.
        each = zip((differ + self.leave).tolist(), (self.low[:-1] * self.num // self.den).tolist(), self.low.tolist(), strict=False)
        self.spare = np.array([_spare(x, least) or _spare(x, low) for x, least, low in each], np.int64)
        self.groups = differ + 1 + self.leave + self.spare

    def of(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, class) for every class in which a set of n shingles may meet a partner."""
        self.grow(int(n.max(initial=1)))
        first = np.searchsorted(self.low, n, side="right") - 1
        last = np.searchsorted(self.low, n * self.den // self.num, side="right") - 1
        k = np.where(n > 0, last - first + 1, 0)
        row = np.repeat(np.arange(len(n)), k)
        return row, first[row] + np.arange(len(row)) - (np.cumsum(k) - k)[row]


def _cells(h: np.ndarray, offs: np.ndarray, classes: Classes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, cell key) of the cells of the sets, and for each set how many frequent cells of a class it may leave out."""
    n = np.diff(offs)
    row, kind = classes.of(n)
    groups = classes.groups[kind]
    size = n[row]
    base = np.cumsum(groups) - groups
    at = np.repeat(offs[row] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    mine = h[at]
    # Which group: the high bits of another hash, scaled to the number of groups.
    part = (T.mix(mine ^ _B) >> np.uint64(32)) * np.repeat(groups, size).astype(np.uint64) >> np.uint64(32)
    slot = np.repeat(base, size) + part.astype(np.int64)
    total = int(groups.sum())
    count = np.bincount(slot, minlength=total)
    check = np.zeros(total, np.uint64)
    np.add.at(check, slot, T.mix(mine * _A))
    owner = np.repeat(np.arange(len(row)), groups)
    number = np.arange(total) - base[owner]
    # The spare groups that are left out are the first by count and number, an order that sets
    # agree on where they agree in a group: of more agreeing groups the last one is never left out.
    order = np.argsort(owner * (int(count.max(initial=0)) + 1) + count, kind="stable")
    emit = np.ones(total, bool)
    emit[order] = number >= classes.spare[kind][owner]
    key = T.mix(check * _B + T.mix((kind[owner] << 32 | number).astype(np.uint64)) + count.astype(np.uint64))
    key = key & ~np.uint64(CLASS) | kind[owner].astype(np.uint64) & np.uint64(CLASS)
    # Its smallest class has the fewest to leave out.
    leave = np.zeros(len(n), np.int64)
    leave[row[::-1]] = classes.leave[kind[::-1]]
    return row[owner[emit]], key[emit], leave


def points(h: np.ndarray, offs: np.ndarray) -> list[bytes]:
    """The counts by group of each set: a group for every shingle, rounded down to a power of
    two. Groups are the low bits of a hash, so a point folds to fewer groups (see ``folded``)."""
    group = T.mix(h ^ _A)
    out = []
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        dims = max(DIMS, (1 << (b - a).bit_length()) >> 1)
        out.append(np.bincount((group[a:b] & np.uint64(dims - 1)).astype(np.int64), minlength=dims).astype("<u4").tobytes())
    return out


def folded(point: list[bytes]) -> np.ndarray:
    """Points as rows of as many groups as the smallest of them has."""
    sizes = set(map(len, point))
    dims = min(sizes, default=4 * DIMS) // 4
    if len(sizes) == 1:
        return np.frombuffer(b"".join(point), "<u4").astype(np.int64).reshape(-1, dims)
    return np.stack([np.frombuffer(p, "<u4").reshape(-1, dims).sum(0, dtype=np.int64) for p in point]) if point else np.zeros((0, dims), np.int64)


def brief(point: bytes, dims: int = DIMS) -> tuple[bytes, int]:
    """A point of so many groups in a byte each, and the unit of these bytes: no coordinate is less than the point's."""
    counts = folded([point, bytes(4 * dims)])[0]
    unit = max(1, -(-int(counts.max(initial=0)) // 255))
    return (-(-counts // unit)).astype(np.uint8).tobytes(), unit


def _describe(words: int, num: int, den: int):
    classes = Classes(num, den)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in T.slices(batch):
                h, offs = shingles(some.column("text"), words)
                point = points(h, offs)
                short = [brief(p, len(p) // 4) for p in point]
                row, key, leave = _cells(h, offs, classes)
                order = np.argsort(row, kind="stable")
                per = np.bincount(row, minlength=some.num_rows)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()), pa.array(key[order].view(np.int64))
                )
                yield pa.record_batch(
                    [
                        some.column("doc_id"), pa.array(np.diff(offs), pa.int64()),
                        pa.array([b for b, _ in short], pa.binary()), pa.array([u for _, u in short], pa.int64()), lists, pa.array(leave),
                    ],
                    ["doc_id", "n", "point", "unit", "cells", "leave"],
                )

    return describe


def _needed(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """The least overlap of linked sets of these sizes: den * inter >= num * (a + b - inter)."""
    return -(-num * (a + b) // (num + den))


class RTree:
    """A bulk-loaded R-tree of points and the sizes of their sets: sorted into tiles, leaves of LEAF
    points, boxes above them. Coordinates may be larger than the counts, never smaller."""

    def __init__(self, point: np.ndarray, size: np.ndarray):
        self.order = self._tiles(np.arange(len(point)), point)
        self.point = point[self.order]
        self.size = size[self.order]
        self.levels = []
        low, high, small, large = self.point, self.point, self.size, self.size
        while len(high) > 1 or not self.levels:
            cut = np.arange(0, len(high), LEAF)
            low, high = np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)
            small, large = np.minimum.reduceat(small, cut), np.maximum.reduceat(large, cut)
            self.levels.append((high, small, large))

    @staticmethod
    def _tiles(at: np.ndarray, point: np.ndarray) -> np.ndarray:
        """An order in which near points are near: halved by the coordinate of the largest spread (the size first)."""
        if len(at) <= LEAF:
            return at
        mine = point[at]
        size = mine.sum(1)
        spread = np.ptp(mine, axis=0)
        key = size if np.ptp(size) >= spread.max() else mine[:, spread.argmax()]
        half = -(-len(at) // 2 // LEAF) * LEAF
        order = at[np.argsort(key, kind="stable")]
        return np.concatenate([RTree._tiles(order[:half], point), RTree._tiles(order[half:], point)])

    def search(self, point: np.ndarray, n: np.ndarray, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, points) that the bound admits, by their numbers, in parts; query i has n[i] shingles.
        Every query descends all boxes that the bound admits; pairs of a query and a box are bounded together."""
        least = -(-n * num // den)
        todo = [(len(self.levels), np.arange(len(n)), np.zeros(len(n), np.int64))] if len(self.order) else []
        while todo:
            level, query, at = todo.pop()
            if len(query) > PAIRS:
                todo += [(level, query[x : x + PAIRS], at[x : x + PAIRS]) for x in range(0, len(query), PAIRS)]
                continue
            high, small, large = self.levels[level - 1] if level else (self.point, self.size, self.size)
            # No overlap exceeds the minima summed; the least size in the box needs the least overlap.
            bound = np.minimum(np.minimum(high[at], point[query]).sum(1, dtype=np.int32), large[at])
            ok = bound >= _needed(np.maximum(small[at], least[query]), n[query], num, den)
            query, at = query[ok], at[ok]
            if not level:
                yield query, self.order[at]
                continue
            below = len(self.levels[level - 2][0]) if level > 1 else len(self.point)
            at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
            todo.append((level - 1, np.repeat(query, LEAF)[at < below], at[at < below]))


class Points:
    """Points in bytes with their units (see ``brief``), by the number of their groups."""

    def __init__(self, point: list[bytes], unit: np.ndarray):
        self.unit = unit.astype(np.int32)
        self.width = np.array([len(p) for p in point], np.int64)
        self.place = np.zeros(len(point), np.int64)
        self.of = {}
        for w in np.unique(self.width).tolist():
            mine = np.flatnonzero(self.width == w)
            self.place[mine] = np.arange(len(mine))
            self.of[w] = np.frombuffer(b"".join([point[i] for i in mine.tolist()]), np.uint8).reshape(-1, w)

    def folded(self, at: np.ndarray, dims: int) -> np.ndarray:
        """Some points of one width as rows of ``dims`` groups."""
        rows = self.of[int(self.width[at[0]])][self.place[at]]
        return rows.reshape(len(at), -1, dims).sum(1, dtype=np.int32) * self.unit[at][:, None]

    def all(self, dims: int) -> np.ndarray:
        out = np.zeros((len(self.width), dims), np.int32)
        for w in self.of:
            for at in self._parts(np.flatnonzero(self.width == w), w):
                out[at] = self.folded(at, dims)
        return out

    def overlap(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The most that points a[i] and b[i] can have in common, by the groups that both have."""
        out = np.zeros(len(a), np.int64)
        wide, narrow = np.maximum(self.width[a], self.width[b]), np.minimum(self.width[a], self.width[b])
        swap = self.width[a] > self.width[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        for w, dims in np.unique(np.stack([wide, narrow], 1), axis=0).tolist():
            for at in self._parts(np.flatnonzero((wide == w) & (narrow == dims)), w):
                if w == dims and (self.unit[a[at]] == 1).all() and (self.unit[b[at]] == 1).all():  # the bytes are the counts
                    mine, other = (self.of[w][self.place[x[at]]] for x in (a, b))
                else:
                    mine, other = (self.folded(x[at], dims) for x in (a, b))
                out[at] = np.minimum(mine, other).sum(1, dtype=np.int32)
        return out

    @staticmethod
    def _parts(at: np.ndarray, width: int) -> list[np.ndarray]:
        return np.array_split(at, max(1, len(at) * width >> 20))


def _rest(num: int, den: int):
    """Pairs across components in the families of a task; rows come sorted by family and tile.
    A pair of several families is given in each."""

    def search(family: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(family)
        doc, comp, side, size = (rows[c].to_numpy() for c in ("doc_id", "comp", "side", "n"))
        fine = Points(rows["point"].to_pylist(), rows["unit"].to_numpy())
        point = fine.all(DIMS)
        a: list[np.ndarray] = []
        b: list[np.ndarray] = []
        # One end of a pair at least lies outside the component that most members are in.
        values, count = np.unique(comp, return_counts=True)
        few = comp != values[count.argmax()]

        def meet(queries: np.ndarray, others: np.ndarray) -> None:
            queries = queries[few[queries]]
            if not len(queries) or not len(others):
                return
            tree = RTree(point[others], size[others])
            for i, k in tree.search(point[queries], size[queries], num, den):
                i, k = queries[i], others[k]
                # Two that are both queries meet once.
                new = (comp[i] != comp[k]) & (~few[k] | (side[i] < side[k]) | (side[i] == side[k]) & (i < k))
                i, k = i[new], k[new]
                new = fine.overlap(i, k) >= _needed(size[k], size[i], num, den)
                a.append(np.minimum(doc[i], doc[k])[new])
                b.append(np.maximum(doc[i], doc[k])[new])

        left, right = np.flatnonzero(side <= 0), np.flatnonzero(side >= 0)
        meet(left, right)
        if side.any():  # two tiles
            meet(right, left)
        pairs = np.unique(np.stack([np.concatenate(x) for x in (a, b)], 1), axis=0) if a else np.zeros((0, 2), np.int64)
        yield pa.record_batch([pa.array(pairs[:, k], pa.int64()) for k in range(2)], ["a", "b"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in ("low", "t", "s")], 1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                if last is not None and tuple(key[x]) != last:
                    yield from search(held)
                    held = []
                last = tuple(key[x])
                held.append(batch.slice(x, y - x))
        if held:
            yield from search(held)

    return join


def _verified(pairs: DataFrame, docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets have the similarity. Both texts come to the task of a;
    the pairs of an a that has many are dealt out to several tasks."""
    salt = F.pmod(F.xxhash64("b"), F.col("k")).cast("int").alias("salt")
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / PART).cast("int").alias("k"))
    dealt = pairs.join(many, "a").select("a", "b", salt)
    ids = dealt.select(F.col("b").alias("doc_id"), "a", "salt", F.lit(1).alias("side")).unionByName(
        dealt.select(F.col("a").alias("doc_id"), "a", "salt", F.lit(0).alias("side")).distinct()
    )
    rows = ids.join(docs, "doc_id").select("a", "salt", "side", "doc_id", "text")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center, sets = None, []
        for batch in batches:
            for some in T.slices(batch):
                h, offs = shingles(some.column("text"), words)
                a, salt, side, doc = (some.column(c).to_numpy() for c in ("a", "salt", "side", "doc_id"))
                linked = []
                for i in range(some.num_rows):
                    mine = h[offs[i] : offs[i + 1]]
                    if (a[i], salt[i]) != center:
                        center, sets = (a[i], salt[i]), []
                    if side[i] == 0:
                        sets.append(mine.copy())
                        continue
                    for other in sets:
                        small, large = (mine, other) if len(mine) < len(other) else (other, mine)
                        if den * len(small) < num * len(large):
                            continue
                        at = np.searchsorted(large, small)
                        at[at == len(large)] = 0
                        inter = int((large[at] == small).sum())
                        if inter and den * inter >= num * (len(small) + len(large) - inter):
                            linked.append(i)
                            break
                yield pa.record_batch([some.column(c).take(pa.array(linked, pa.int64())) for c in ("a", "doc_id")], ["a", "b"])

    return rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "side").mapInArrow(verify, "a long, b long")


def _admitted(pairs: DataFrame, described: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose points admit the similarity."""
    p = described.select("doc_id", "point", "unit", "n")
    both = pairs.join(p.toDF("a", "pa", "ua", "na"), "a").join(p.toDF("b", "pb", "ub", "nb"), "b")

    def admit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # As many pairs at once as their points allow; wider ones come alone.
            width = sum(pc.binary_length(batch.column(c)).to_numpy().astype(np.int64) for c in ("pa", "pb"))
            part = np.cumsum(width) // TILE_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                some = batch.slice(x, y - x)
                n = np.arange(some.num_rows)
                points = Points(some.column("pa").to_pylist() + some.column("pb").to_pylist(), np.concatenate([some.column(c).to_numpy() for c in ("ua", "ub")]))
                need = _needed(some.column("na").to_numpy(), some.column("nb").to_numpy(), num, den)
                ok = pa.array(points.overlap(n, n + len(n)) >= need)
                yield pa.record_batch([some.column(c).filter(ok) for c in ("a", "b")], ["a", "b"])

    return both.select("a", "b", "pa", "pb", "ua", "ub", "na", "nb").mapInArrow(admit, "a long, b long")


def _shared(members: DataFrame, *more: Column) -> DataFrame:
    """Cells with at least two documents, with the smallest and the largest of them."""
    return members.groupBy("cell").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), *more).where("low < high")


def _left(often: DataFrame) -> DataFrame:
    """What documents keep of their frequent cells: the most frequent ones of a class are left out, so many as ``leave`` says."""
    order = Window.partitionBy("doc_id", F.col("cell").bitwiseAND(CLASS)).orderBy(F.desc("of"), "cell")
    return often.withColumn("place", F.dense_rank().over(order)).where("place > leave").select("cell", "doc_id")


def jaccard_join(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; linked where den * inter >= num * union."""
    stage = Stage(docs.sparkSession, "jaccard")
    docs = texts(docs)
    described = stage.write(docs.mapInArrow(_describe(words, num, den), "doc_id long, n long, point binary, unit long, cells array<long>, leave long"), "described")
    members = described.where("doc_id is not null").select("doc_id", "leave", F.explode("cells").alias("cell"))

    def of_pass(df: DataFrame, p: int) -> DataFrame:
        return df.where(F.pmod(F.col("cell"), F.lit(PASSES)) == p)

    met = None
    for p in range(PASSES):
        some = of_pass(members, p)
        shared = _shared(some, F.count("*").alias("of"))
        some = stage.write(some.join(stage.write(shared, f"shared-{p}"), "cell"), f"met-{p}")
        stage.drop(f"shared-{p}")
        met = some if met is None else met.unionByName(some)
    often = stage.write(_left(met.where(F.col("of") >= OFTEN)), "left")
    met = met.where(F.col("of") < OFTEN).select("cell", "doc_id", "low", "high").unionByName(
        stage.write(often.join(_shared(often), "cell"), "often").select("cell", "doc_id", "low", "high")
    )
    described = stage.write(described.select("doc_id", "n", "point", "unit"), "points")
    stage.drop("described")
    # Every document with the smallest id of each of its cells.
    family = stage.write(met.select("low", "doc_id").distinct(), "families")
    # The texts that verification may need: written once, the others stay where they are.
    known = stage.write(docs.where("text is not null").join(family.select("doc_id").distinct(), "doc_id", "left_semi"), "known", key="doc_id")
    edges = None
    for center in ("low", "high"):
        star = family if center == "low" else met.select(center, "doc_id").distinct()
        star = star.where(F.col("doc_id") != F.col(center)).select(F.least(center, "doc_id").alias("a"), F.greatest(center, "doc_id").alias("b"))
        if edges is not None:  # not again what is in one component
            star = star.join(edges, ["a", "b"], "left_anti")
            star = star.join(groups.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(
                groups.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left"
            ).where("ca is null or cb is null or ca <> cb").select("a", "b")
        pairs = stage.write(_admitted(star, described, num, den), f"pairs-{center}")  # read twice
        linked = _verified(pairs, known, words, num, den)
        edges = stage.write(linked if edges is None else linked.unionByName(edges), f"edges-{center}")
        groups = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    stage.drop(*[f"met-{p}" for p in range(PASSES)], "left", "often")
    # Families that still hold several components.
    placed = family.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "low", "doc_id", F.coalesce("component", "doc_id").alias("comp")
    )
    several = placed.groupBy("low").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("low")
    inside = stage.write(placed.join(several, "low"), "open")
    tiles = F.ceil(F.greatest(F.count("*") / TILE, F.sum("bytes") / TILE_BYTES)).cast("int")
    sized = inside.join(described.select("doc_id", F.length("point").alias("bytes")), "doc_id")
    tiles = stage.write(sized.groupBy("low").agg(tiles.alias("tiles")), "tiles")
    dealt = inside.join(tiles, "low").withColumn("tile", F.pmod(F.xxhash64("doc_id"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "low", "doc_id", "comp", F.least("tile", "other").alias("t"), F.greatest("tile", "other").alias("s"),
        F.when(F.col("tile") == F.col("other"), 0).when(F.col("tile") < F.col("other"), -1).otherwise(1).alias("side"),
    )
    dealt = dealt.join(described, "doc_id")
    pairs = dealt.repartition("low", "t", "s").sortWithinPartitions("low", "t", "s").mapInArrow(_rest(num, den), "a long, b long")
    pairs = stage.write(pairs.distinct(), "pairs-rest")  # read twice
    rest = stage.write(_verified(pairs, known, words, num, den).unionByName(edges), "edges-all")
    stage.drop(*[x for x in stage.paths if x not in ("points", "edges-all")])
    groups = components(rest.select(F.col("a").alias("u"), F.col("b").alias("v"))).withColumnRenamed("node", "doc_id")
    return described.select("doc_id", F.col("n").alias("n_shingles")).join(groups, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
