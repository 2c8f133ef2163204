"""Substring dedup by line hashing (operator 10).

Every line with a word in it is hashed, whole or by its sentences. A sentence
ends with its line, or with a full stop, question or exclamation mark before
white space. Sentences of at least ``min_words`` words are units of their own; a
line that has no such sentence (a short line, or one in a script without
spaces) is one unit. So of a line only short sentences beside a longer one are
not looked up. Units are normalised to their words (lower-case ASCII, letters
and digits, single spaces between) and grouped by a 128-bit digest of these
bytes over the whole corpus. The earliest occurrence, by doc_id, text and
offset, stays; every other one is removed, and keeps the offsets it has in the
original text.

The grouped minimum is combined before the shuffle and the digests are joined
back, so a line that a third of all documents share is no bottleneck. Only
digests and offsets are shuffled, no text.

Null and empty texts have no units; a null doc_id ranks first; rows that
repeat both id and text are one document, so none of them loses to another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import Stage, texts

MIN_WORDS = 6
UNITS = "doc_id long, text_key long, start long, end long, n_words long, d1 long, d2 long"
_STOP = np.isin(np.arange(256), list(b".!?"))
_SPACE = ~T.NOT_SPACE
_SEEDS = (11, 12)


def units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every unit that counts: doc_id, text_key (a hash of its text), start and end in characters, n_words, digest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in T.slices(batch):
                buf, offs = T.flat(some.column("text"))
                n = len(buf)
                if not n:
                    continue
                low = T.LOWER[buf]
                stop = _STOP[buf]
                stop[:-1] &= _SPACE[buf[1:]]
                line = np.zeros(n + 1, bool)  # a line ends before this byte
                line[1:] = buf == 10
                line[offs] = True
                ends = line.copy()  # a sentence does
                ends[1:] |= stop
                edge = np.flatnonzero(ends)
                s, e, _ = T.spans(low, offs, T.ALNUM)
                words = np.diff(np.searchsorted(s, edge))
                own = words >= min_words  # sentences that are units
                of_line = np.cumsum(line[edge[:-1]]) - 1
                whole = np.bincount(of_line, own) == 0  # lines that are
                lines = np.flatnonzero(line)
                a = np.concatenate([edge[:-1][own], lines[:-1][whole]])
                b = np.concatenate([edge[1:][own], lines[1:][whole]])
                first, last = np.searchsorted(s, a), np.searchsorted(s, b)
                some_words = np.flatnonzero(last > first)
                if not len(some_words):
                    continue
                first, last, b = first[some_words], last[some_words], b[some_words]
                a = s[first]  # without the white space before the first word
                # The bytes of words, and one space for each gap.
                word = T.ALNUM[low]
                keep = word.copy()
                keep[1:] |= word[:-1]
                at = np.concatenate([[0], np.cumsum(keep)])
                plain = np.where(word, low, 0x20).astype(np.uint8)[keep]
                digests = [T.word_keys(plain, at[a], at[e[last - 1]], seed) for seed in _SEEDS]
                row = np.searchsorted(offs, a, side="right") - 1
                chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
                begin = chars[offs[row]]
                yield pa.record_batch(
                    [
                        some.column("doc_id").take(pa.array(row)),
                        some.column("text_key").take(pa.array(row)),
                        pa.array(chars[a] - begin, pa.int64()),
                        pa.array(chars[b] - begin, pa.int64()),
                        pa.array(last - first, pa.int64()),
                        *[pa.array(d.view(np.int64), pa.int64()) for d in digests],
                    ],
                    ["doc_id", "text_key", "start", "end", "n_words", "d1", "d2"],
                )

    rows = texts(docs).where("text is not null and text <> ''").select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return rows.mapInArrow(cut, UNITS)


def repeated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every removal: doc_id, start, end, n_words, first_doc_id and first_start of the occurrence that stays, text_key."""
    stage = Stage(docs.sparkSession, "repeats")
    found = stage.write(units(docs, min_words), "units")
    rank = F.struct("doc_id", "text_key", "start")
    first = found.groupBy("d1", "d2").agg(F.min(rank).alias("first"), F.max(rank).alias("last")).where("first <> last")
    again = found.join(first.select("d1", "d2", "first"), ["d1", "d2"]).where(~rank.eqNullSafe(F.col("first"))).distinct()
    return again.select(
        "doc_id", "start", "end", "n_words", F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.start").alias("first_start"), "text_key",
    )


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the repeated units cut out of the texts."""
    gone = repeated(docs, min_words).groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_gone")
    )
    joined = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"].cast("string")) == gone["_key"]), "left")
    starts = F.concat(F.array(F.lit(0)), F.transform("_gone", lambda x: x["end"]))
    ends = F.concat(F.transform("_gone", lambda x: x["start"]), F.array(F.length("text").cast("long")))
    left = F.zip_with(starts, ends, lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int")))
    text = F.when(F.col("_gone").isNotNull(), F.array_join(left, "")).otherwise(F.col("text"))
    return joined.withColumn("text", text).drop("_id", "_key", "_gone")
