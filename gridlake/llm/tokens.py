"""Token ids by the tokenizers library, one call for each distinct word.

The tokenizer drops white space, and none of its pieces crosses it, so the ids
of a text are the ids of its space-separated words in order. A worker keeps the
ids of the words it has met (a bounded cache, which changes no result), so that
a frequent word isn't encoded again.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from . import text as T

CACHE_WORDS = 1_000_000
ENCODE_BYTES = 4 << 20  # of text encoded together: the more, the fewer words twice


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of known words
        self.at = np.zeros(0, np.int64)  # where the ids of each begin
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        got = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        length = np.fromiter(map(len, got), np.int64, len(got))
        new = np.fromiter((i for x in got for i in x), np.uint32, int(length.sum()))
        at = len(self.ids) + np.cumsum(length) - length
        keys, at, length = np.concatenate([self.keys, keys]), np.concatenate([self.at, at]), np.concatenate([self.length, length])
        order = np.argsort(keys)
        self.keys, self.at, self.length = keys[order], at[order], length[order]
        self.ids = np.concatenate([self.ids, new])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of text i are ids[offsets[i]:offsets[i + 1]]; null has none."""
        buf, offs = T.flat(texts)
        if b"<|" not in buf.tobytes():  # names of special tokens are matched as they are written
            buf = T.LOWER[buf]
        s, e, row = T.spans(buf, offs, T.NOT_SPACE)
        h = T.hashes(buf, s, e)
        first, number = T.distinct(h)
        keys = h[first]
        if len(self.keys) + len(keys) > CACHE_WORDS:
            self.clear()
        place = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != keys[inside]
        if new.any():
            f = first[new]
            self._learn(keys[new], T.strings(buf, s[f], e[f]))
            place = np.searchsorted(self.keys, keys)
        length = self.length[place][number]
        end = np.cumsum(length)
        # Position j of the output lies in word w at j - start(w).
        ids = self.ids[np.repeat(self.at[place][number] - (end - length), length) + np.arange(end[-1] if len(end) else 0)]
        per_row = np.bincount(row, weights=length, minlength=len(offs) - 1).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(per_row)])


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
