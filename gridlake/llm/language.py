"""Language identification by segmentation-marginalised unigrams (operator 9).

Every language has a probability for each piece of a fixed public vocabulary.
The likelihood of a word is the sum, over all ways to cut it into pieces, of
the product of their probabilities (the forward algorithm); pieces don't cross
words, so a text's log likelihood is the sum over its words. The forward pass
walks a trie of the pieces for many words at once and runs once for each
distinct word a task meets. A long word is walked in windows: the sums that reach
beyond a window, by at most the longest piece, are carried into the next.

The piece probabilities are fitted by expectation maximisation (forward and
backward passes) on the words of a bounded sample of labelled texts: about
``docs_per_language`` of each language, chosen by a hash of the id. Everything
else covers all rows.

A null text, or one without any letter, is ``und`` with score 0; so is every
text if there is nothing to learn from. Equal likelihoods go to the language
that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import held_out, texts, unit_hash

UNKNOWN = "und"
WORD_CHARS = 32  # of a window of a longer word; in training, longer words are cut into as many characters
CACHE_WORDS = 300_000
_START, _OTHER = 1, 0  # character numbers: start of a word; any character without a number


def vocabulary(path: str) -> list[str]:
    """The pieces of a sentencepiece model that can be part of a word; ``\\u2581`` starts a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if p.lstrip("▁").isalpha() and "▁" not in p[1:] or p == "▁")


class Trie:
    """Pieces as a trie over numbered characters; piece 0 is any character without a number."""

    def __init__(self, pieces: list[str]):
        chars = sorted(set("".join(pieces)) - {"▁"})
        self.char = np.array([ord(c) for c in chars], np.int64)
        self.width = len(chars) + 2
        number = {"▁": _START} | {c: i + 2 for i, c in enumerate(chars)}
        edges: dict[int, int] = {}
        piece = [-1]
        for i, p in enumerate(pieces):
            node = 0
            for c in p:
                key = node * self.width + number[c]
                if key not in edges:
                    edges[key] = len(piece)
                    piece.append(-1)
                node = edges[key]
            piece[node] = i + 1
        self.n_pieces = len(pieces) + 1
        self.longest = max(map(len, pieces), default=1)
        self.piece = np.array(piece, np.int64)
        order = np.array(sorted(edges), np.int64)
        self.key, self.child = order, np.array([edges[k] for k in order.tolist()], np.int64)

    def numbers(self, words: list[str], most: int = WORD_CHARS) -> tuple[np.ndarray, np.ndarray]:
        """(matrix, lengths): the characters of ``\\u2581word`` for words of at most ``most``."""
        code = np.frombuffer("\n".join(words).encode("utf-32-le", "replace"), "<u4").astype(np.int64)
        cut = np.concatenate([[-1], np.flatnonzero(code == 10), [len(code)]])
        length = np.diff(cut)  # with the mark at the start
        at = np.searchsorted(self.char, code)
        at[at == len(self.char)] = 0
        code = np.where(self.char[at] == code, at + 2, _OTHER)
        out = np.full((len(words), most + 1), -1, np.int64)
        out[:, 0] = _START
        row = np.repeat(np.arange(len(words)), length - 1)
        col = np.arange(len(row)) - np.repeat(np.cumsum(length - 1) - (length - 1), length - 1) + 1
        out[row, col] = code[cut[row] + col]
        return out, length

    def arcs(self, chars: np.ndarray, length: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, words, pieces) for all places of pieces in the words, by start."""
        for start in range(chars.shape[1]):
            rows = np.flatnonzero(length > start)
            if not len(rows):
                return
            other = rows[chars[rows, start] == _OTHER]
            if len(other):
                yield start, start + 1, other, np.zeros(len(other), np.int64)
            node = np.zeros(len(rows), np.int64)
            for end in range(start, chars.shape[1]):
                live = length[rows] > end
                rows, node = rows[live], node[live]
                if not len(rows):
                    break
                key = node * self.width + chars[rows, end]
                at = np.searchsorted(self.key, key)
                at[at == len(self.key)] = 0
                ok = self.key[at] == key
                rows, node = rows[ok], self.child[at[ok]]
                piece = self.piece[node]
                has = piece >= 0
                if has.any():
                    yield start, end + 1, rows[has], piece[has]


@dataclass
class Model:
    languages: list[str]
    trie: Trie
    prob: np.ndarray  # pieces x languages

    def words(self, words: list[str]) -> np.ndarray:
        """log P(word) in each language, words x languages."""
        out = np.zeros((len(words), len(self.languages)))
        size = np.array([len(w) for w in words], np.int64)
        short, long = np.flatnonzero(size <= WORD_CHARS), np.flatnonzero(size > WORD_CHARS)
        for a in range(0, len(short), 16384):
            some = short[a : a + 16384]
            chars, length = self.trie.numbers([words[i] for i in some])
            alpha = np.zeros((len(length), WORD_CHARS + 2, len(self.languages)))
            alpha[:, 0] = 1
            for start, end, rows, piece in self.trie.arcs(chars, length):
                alpha[rows, end] += alpha[rows, start] * self.prob[piece]
            out[some] = np.log(alpha[np.arange(len(length)), length])
        for a in range(0, len(long), 4096):
            some = long[a : a + 4096]
            out[some] = self._long([words[i] for i in some])
        return out

    def _long(self, words: list[str]) -> np.ndarray:
        """log P(word) of words of any length, window by window; what is carried on is scaled to a maximum of 1."""
        k, reach = len(self.languages), self.trie.longest
        out, scale = np.zeros((len(words), k)), np.zeros((len(words), k))
        left = np.array([len(w) + 1 for w in words], np.int64)  # with the mark at the start
        active, carry, at = np.arange(len(words)), np.zeros((len(words), reach, k)), 0
        carry[:, 0] = 1
        while len(active):
            chars, length = self.trie.numbers([words[i][max(at - 1, 0) : at - 1 + WORD_CHARS + reach] for i in active], WORD_CHARS + reach)
            if at:
                chars, length = chars[:, 1:], length - 1
            alpha = np.zeros((len(active), WORD_CHARS + reach, k))
            alpha[:, :reach] = carry
            for start, end, rows, piece in self.trie.arcs(chars, length):
                if start >= WORD_CHARS:
                    break
                alpha[rows, end] += alpha[rows, start] * self.prob[piece]
            done = np.flatnonzero(left[active] <= WORD_CHARS)
            out[active[done]] = np.log(alpha[done, left[active[done]]]) + scale[active[done]]
            more = np.flatnonzero(left[active] > WORD_CHARS)
            active, carry = active[more], alpha[more, WORD_CHARS:]
            top = carry.max(1)
            carry = carry / np.where(top > 0, top, 1)[:, None]
            scale[active] += np.log(top)
            left[active] -= WORD_CHARS
            at += WORD_CHARS
        return out


def fit(words: dict[str, list[tuple[str, int]]], pieces: list[str], rounds: int = 6, floor: float = 1e-7) -> Model:
    """Piece probabilities of each language from its (word, count) rows by expectation maximisation."""
    trie = Trie(pieces)
    languages = sorted(words)
    prob = np.empty((trie.n_pieces, len(languages)))
    for j, language in enumerate(languages):
        tally: dict[str, int] = {}
        for w, n in words[language]:
            for i in range(0, len(w), WORD_CHARS):
                tally[w[i : i + WORD_CHARS]] = tally.get(w[i : i + WORD_CHARS], 0) + n
        chars, length = trie.numbers(list(tally)) if tally else (np.zeros((0, 1), np.int64), np.zeros(0, np.int64))
        count = np.array(list(tally.values()), float)
        arcs = list(trie.arcs(chars, length))
        p = np.full(trie.n_pieces, 1.0 / trie.n_pieces)
        for _ in range(rounds):
            alpha = np.zeros((len(length), WORD_CHARS + 2))
            alpha[:, 0] = 1
            for start, end, rows, piece in arcs:
                alpha[rows, end] += alpha[rows, start] * p[piece]
            beta = np.zeros_like(alpha)
            total = alpha[np.arange(len(length)), length]
            beta[np.arange(len(length)), length] = count / total
            expected = np.zeros(trie.n_pieces)
            for start, end, rows, piece in reversed(arcs):
                through = beta[rows, end] * p[piece]
                expected += np.bincount(piece, alpha[rows, start] * through, trie.n_pieces)
                beta[rows, start] += through
            p = (expected + floor * expected.sum()) / (expected.sum() * (1 + floor * trie.n_pieces)) if expected.sum() else p
        prob[:, j] = p
    return Model(languages, trie, prob)


def train(docs: DataFrame, pieces: list[str], docs_per_language: int = 300, seed: int = 9) -> Model:
    """Fit on labelled documents (doc_id, text, lang) outside the held-out fold."""
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    ).where("doc_id is not null and text is not null and lang is not null").where(~held_out(F.col("doc_id")))
    have = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row for each language
    share = F.coalesce(F.create_map([x for k, n in have.items() for x in (F.lit(k), F.lit(docs_per_language / n))])[F.col("lang")], F.lit(0.0)) if have else F.lit(0.0)
    sample = known.where(unit_hash(F.col("doc_id"), seed) < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in T.slices(batch):
                langs = np.array(some.column("lang").to_pylist(), object)
                buf, offs = T.flat(some.column("text"))
                buf = T.LOWER[buf]
                s, e, row = T.spans(buf, offs, T.LETTER)
                for lang in dict.fromkeys(langs):
                    mine = langs[row] == lang
                    a, b = s[mine], e[mine]
                    first, number = T.distinct(T.hashes(buf, a, b))
                    words = [w.lower() for w in T.strings(buf, a[first], b[first])]
                    yield pa.record_batch(
                        [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()), pa.array(np.bincount(number, minlength=len(words)), pa.int64())],
                        ["lang", "word", "n"],
                    )

    words: dict[str, list[tuple[str, int]]] = {k: [] for k in have}
    tally = sample.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    for r in tally.orderBy("lang", "word").toLocalIterator():  # the words of the bounded sample
        words[r["lang"]].append((r["word"], r["n"]))
    return fit(words, pieces)


class Scorer:
    """Scores texts in a task; remembers the likelihoods of words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.value = np.zeros((0, len(self.model.languages) + 1))  # the last: 1 if there is a letter

    def score(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        k = len(self.model.languages)
        buf, offs = T.flat(texts)
        buf = T.LOWER[buf]
        s, e, row = T.spans(buf, offs, T.LETTER)
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
            words = [w.lower() for w in T.strings(buf, s[first[new]], e[first[new]])]
            value = np.empty((len(words), k + 1))
            value[:, :k] = self.model.words(words)
            value[:, k] = [w.isalpha() or any(map(str.isalpha, w)) for w in words]
            value[value[:, k] == 0, :k] = 0
            keys_all = np.concatenate([self.keys, keys[new]])
            order = np.argsort(keys_all)
            self.keys, self.value = keys_all[order], np.concatenate([self.value, value])[order]
            place = np.searchsorted(self.keys, keys)
        value = self.value[place][number] if len(keys) else np.zeros((0, k + 1))
        total = np.stack([np.bincount(row, value[:, j], len(offs) - 1) for j in range(k + 1)], 1)
        log = total[:, :k]
        if not k:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = log.argmax(1)
        score = 1 / np.exp(log - log.max(1, keepdims=True)).sum(1)
        lettered = total[:, k] > 0
        pred = [self.model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered.tolist(), strict=True)]
        return pred, np.where(lettered, score, 0.0)


_SCORER: list[tuple[int, Scorer]] = []


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score; the text alone decides. Columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        if not _SCORER or _SCORER[0][0] != id(model):
            _SCORER[:] = [(id(model), Scorer(model))]
        for batch in batches:
            for some in T.slices(batch):
                pred, score = _SCORER[0][1].score(some.column("text"))
                yield pa.record_batch(
                    [some.column(c) for c in kept] + [pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                    [*kept, "lang_pred", "score"],
                )
        _SCORER.clear()  # the words of one task only: the worker lives on for other stages
        T.release()

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", lang_pred string, score double"
    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(predict, schema)


def op_frame(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    scored = identify(texts(docs), model)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
