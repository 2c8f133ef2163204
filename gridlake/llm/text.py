"""Vectorised words of Arrow text columns: spans, 64-bit hashes, distinct words.

All functions work on the UTF-8 bytes of a slice of a batch, so that a word
costs a few numpy steps and no Python object.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

try:  # of the GNU C library; elsewhere the allocator is left to itself
    _TRIM = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):
    _TRIM = None

SLICE_BYTES = 1 << 20

_FACTOR, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def table(*ranges: tuple[int, int]) -> np.ndarray:
    """A byte table that is true in the given inclusive ranges."""
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a : b + 1] = True
    return t


#: Everything but ASCII white space.
NOT_SPACE = ~(table((0x20, 0x20)) | table((0x09, 0x0D)))
#: ASCII digits and letters, and all bytes of other characters.
ALNUM = table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: ASCII letters and all bytes of other characters.
LETTER = table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def release() -> None:
    """Give memory that isn't in use back to the system, which a worker that lives on would keep."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def slices(batch: pa.RecordBatch, column: str = "text", budget: int = SLICE_BYTES, trim: bool = True) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in runs of about ``budget`` bytes of text; a longer text comes alone."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(size) // budget
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(size)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(a, b - a)
    if trim:
        release()


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): text i is bytes[offsets[i]:offsets[i + 1]]; null is empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offs = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offs - offs[0]


def spans(buf: np.ndarray, offs: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each maximal run of word bytes; no run crosses a row."""
    n = len(buf)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    m = word[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.zeros(n, bool)
    before[1:] = m[:-1]
    after = np.zeros(n, bool)
    after[:-1] = m[1:]
    s = np.flatnonzero(m & (~before | edge[:n]))
    e = np.flatnonzero(m & (~after | edge[1:])) + 1
    return s, e, np.searchsorted(offs, s, side="right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_keys(buf: np.ndarray, s: np.ndarray, e: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit key of each span, eight bytes mixed at a time, so not linear in the bytes; another seed, other keys."""
    wide = np.concatenate([buf, np.zeros(8, np.uint8)])
    at = np.ndarray(len(buf) + 1, np.dtype("<u8"), wide, strides=(1,))
    h = mix((e - s).astype(np.uint64) + mix(np.full(1, seed, np.uint64)))
    todo, left, p = np.arange(len(s)), e - s, s
    while len(todo):
        rest = np.minimum(left, 8).astype(np.uint64)
        v = at[p] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * rest))
        h[todo] = mix((h[todo] ^ v) * _FACTOR + _STEP)
        more = left > 8
        todo, left, p = todo[more], left[more] - 8, p[more] + 8
    return h


def hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: equal bytes, equal hash."""
    return word_keys(buf, s, e, 0)


def distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first position of each distinct hash, number of the hash of each position)."""
    order = np.argsort(h, kind="stable")
    first = np.ones(len(h), bool)
    first[1:] = h[order][1:] != h[order][:-1]
    number = np.empty(len(h), np.int64)
    number[order] = np.cumsum(first) - 1
    return order[first], number


def strings(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> list[str]:
    """The spans as strings."""
    data = buf.tobytes()
    return [data[a:b].decode("utf-8", "replace") for a, b in zip(s.tolist(), e.tolist(), strict=True)]
