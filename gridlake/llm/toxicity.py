"""Toxicity by a subsequence string kernel and a linear support vector machine (operator 6).

The kernel of two strings counts the character subsequences of length ``ORDER``
that they share, each weighted by a decay for every character it spans, so an
insult with gaps or inserted characters stays close to the plain one. It is
divided by the landmark's kernel with itself and cut off at 1, so a word that
holds a landmark whole, as an inflected one does, has 1 whatever follows. A
Nystroem map over the landmarks turns it into a vector; a sentence has, for each
landmark, the kernel with its most similar token; a support vector machine
scores sentences. A text is judged by its worst sentence and, for each landmark,
by how often similar tokens come back (the squares of their kernels summed, as
a logarithm), given its length: a stem that an innocent text holds once counts
when it is repeated.
A second machine weighs these, calibrated to a probability.

Training: a bounded sample of labelled documents (``SAMPLE`` of each label, by
a hash of the id). Landmarks are the tokens and beginnings of tokens that tell
most about the label, chosen one after the other until they cover the toxic
texts several times; beginnings may be as long as a landmark. All sentences of a clean document are clean; of a toxic one
those are toxic that score above 0 and the one that scores highest, which is
found anew in each round. The highest of the clean documents, by which these are
judged, count together as much again as all clean sentences.

Scoring covers every token of every whole text. A worker evaluates the kernel
once for each distinct token it meets, on every stretch of it that is ``GAP``
bytes longer than the landmark, with every landmark that has ``ORDER`` letters
in common with it; with the others the kernel is 0. The Nystroem map whitens by
the same values of the landmarks themselves. Signs inside a token are left out,
letters written with spaces between them make one token, and a token of over
``SPAN`` bytes is taken as several overlapping ones.

Null and empty texts have the score of a text without any similar token. If a
label has no examples, every score is the share of toxic examples (0 if none).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T
from .common import held_out, texts, unit_hash

ORDER, DECAY = 4, 0.8
LONGEST = 10  # bytes of a landmark
GAP = 3  # bytes by which a stretch of a token may be longer than the landmark it is compared with
SPAN = 32
LANDMARKS = 40
TIMES = (1, 3)  # how often a text may have to hold a word for it to tell something
LEAST_GAIN = 3.0  # what a landmark tells at least, as a logarithm
SAMPLE = 1500
CACHE_WORDS = 1_000_000
CACHE_VALUES = 400_000  # of the remembered words, those with a similar landmark
_LETTER = T.LETTER | T.table((0x30, 0x39))
_END = np.isin(np.arange(256), list(b".!?"))
_KIND = np.full(256, 31)  # letters by themselves, other bytes together
_KIND[0x61:0x7B] = np.arange(26)


def kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The kernel of row i of s with row i of t: bytes, padded with different values beyond their ends."""
    n, width = len(s), t.shape[1]
    s, t = np.ascontiguousarray(s.T), np.ascontiguousarray(t.T)
    square = DECAY * DECAY
    before = [np.ones((width + 1, n))] + [np.zeros((width + 1, n)) for _ in range(ORDER - 1)]
    total = np.zeros(n)
    for a in range(len(s)):
        match = s[a] == t
        total += (match * before[ORDER - 1][:-1]).sum(0) * square
        for i in range(ORDER - 1, 0, -1):
            run = np.zeros(n)
            before[i] *= DECAY
            for b in range(width):
                run = run * DECAY + match[b] * (square * before[i - 1][b])
                before[i][b + 1] += run
    return total


def _rows(words: list[bytes], pad: int) -> np.ndarray:
    out = np.full((len(words), max(map(len, words), default=1)), pad, np.uint8)
    for i, w in enumerate(words):
        out[i, : len(w)] = np.frombuffer(w, np.uint8)
    return out


class Landmarks:
    """Kernel values of many tokens with some landmarks, 1 for a token that holds the landmark."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.rows = _rows(words, 1)
        self.own = kernel(_rows(words, 0), self.rows) if words else np.zeros(0)
        self.count = np.array([np.bincount(_KIND[np.frombuffer(w, np.uint8)], minlength=32) for w in words], np.uint8).reshape(-1, 32)
        self.size = np.array([len(w) for w in words], np.int64)

    def values(self, buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(token, landmark, value) where the value isn't 0."""
        n, size = len(s), e - s
        at = np.repeat(s - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        row = np.repeat(np.arange(n), size)
        count = np.minimum(np.bincount(row * 32 + _KIND[buf[at]], minlength=n * 32), 255).astype(np.uint8).reshape(n, 32)
        pairs = []
        for c in self.count:
            shared = np.zeros(n, np.int64)
            for k in np.flatnonzero(c):
                shared += np.minimum(count[:, k], c[k])
            pairs.append(np.flatnonzero(shared >= ORDER))
        token = np.concatenate([*pairs, np.zeros(0, np.int64)])
        mark = np.repeat(np.arange(len(pairs)), [len(p) for p in pairs])
        if not len(token):
            return token, mark, np.zeros(0)
        chars = np.zeros((n, SPAN + LONGEST + GAP), np.uint8)
        chars[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = buf[at]
        wide = self.size[mark] + GAP
        stretches = np.maximum(1, size[token] - wide + 1)
        pair = np.repeat(np.arange(len(token)), stretches)
        start = np.arange(len(pair)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        value = np.zeros(len(token))
        for a in range(0, len(pair), 16384):
            p = pair[a : a + 16384]
            columns = np.arange(LONGEST + GAP)
            some = chars[token[p][:, None], start[a : a + 16384, None] + columns]
            some[columns >= wide[p][:, None]] = 0
            np.maximum.at(value, p, kernel(some, self.rows[mark[p]]) / self.own[mark[p]])
        value = np.minimum(value, 1)
        ok = value > 0
        return token[ok], mark[ok], value[ok]


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end, row, sentence) of all tokens, in lower case and without signs."""
    buf, offs = T.flat(texts)
    n = len(buf)
    if not n:
        return (buf, *[np.zeros(0, np.int64)] * 4)
    stop = np.zeros(n + 1, np.int64)
    stop[1:] = (buf == 10) | (_END[buf] & np.concatenate([~T.NOT_SPACE[buf[1:]], [True]]))
    stop[offs] = 1
    sentence = np.cumsum(stop)[:-1]
    kept = _LETTER[buf] | ~T.NOT_SPACE[buf]
    offs = np.concatenate([[0], np.cumsum(kept)])[offs]
    buf, sentence = T.LOWER[buf[kept]], sentence[kept]
    s, e, row = T.spans(buf, offs, T.NOT_SPACE)
    sentence = sentence[s]
    # Runs of single letters, written once more without the spaces.
    single = e - s == 1
    other = row[1:] != row[:-1]  # a run ends with its text
    begin = np.flatnonzero(single & np.concatenate([[True], ~single[:-1] | other]))
    end = np.flatnonzero(single & np.concatenate([~single[1:] | other, [True]])) + 1
    more, first = [buf], len(buf)
    extra: list[tuple[int, int, int, int]] = []
    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
        if b - a >= ORDER:
            more.append(buf[s[a:b]])
            extra.append((first, first + b - a, row[a], sentence[a]))
            first += b - a
    if extra:
        s, e, row, sentence = (np.concatenate([x, np.array(y)]) for x, y in zip((s, e, row, sentence), zip(*extra, strict=True), strict=True))
        buf = np.concatenate(more)
    # Long ones in overlapping stretches.
    step = SPAN - LONGEST - GAP
    pieces = np.maximum(1, -(-(e - s - SPAN) // step) + 1)
    k = np.repeat(np.arange(len(s)), pieces)
    start = s[k] + (np.arange(len(k)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * step
    return buf, start, np.minimum(start + SPAN, e[k]), row[k], sentence[k]


class Featuriser:
    """Sentences as kernel values with the landmarks; remembers the tokens it has met."""

    def __init__(self, marks: Landmarks):
        self.marks = marks
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slot = np.zeros(0, np.int64)  # row of values, or -1: no similar landmark
        self.values = np.zeros((0, len(self.marks.words)), np.float32)

    def sentences(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row, values) of the sentences that have a similar token."""
        return self.parts(texts)[:2]

    def parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, values) of the sentences that have a similar token, and for each text how often each landmark comes back and how many
        tokens it has, as logarithms."""
        buf, s, e, row, sentence = tokens(texts)
        m = len(self.marks.words)
        often = np.zeros((len(texts), m + 1))
        often[:, m] = np.log1p(np.bincount(row, minlength=len(texts)))
        none = np.zeros(0, np.int64), np.zeros((0, m), np.float32), often
        if not len(s) or not m:
            return none
        h = T.hashes(buf, s, e)
        first, number = T.distinct(h)
        keys = h[first]
        if len(self.keys) + len(keys) > CACHE_WORDS or len(self.values) > CACHE_VALUES:
            self.clear()
        place = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != keys[inside]
        if new.any():
            f = first[new]
            token, mark, value = self.marks.values(buf, s[f], e[f])
            used, at = np.unique(token, return_inverse=True)
            more = np.zeros((len(used), m), np.float32)
            more[at, mark] = value
            slot = np.full(len(f), -1)
            slot[used] = len(self.values) + np.arange(len(used))
            keys_all = np.concatenate([self.keys, keys[new]])
            order = np.argsort(keys_all)
            self.keys, self.slot = keys_all[order], np.concatenate([self.slot, slot])[order]
            self.values = np.concatenate([self.values, more])
            place = np.searchsorted(self.keys, keys)
        slot = self.slot[place][number]
        near = np.flatnonzero(slot >= 0)
        near = near[np.argsort(sentence[near], kind="stable")]
        head = np.flatnonzero(np.diff(sentence[near], prepend=-1))
        if not len(head):
            return none
        values = self.values[slot[near]]
        first = np.flatnonzero(np.diff(row[near], prepend=-1))
        often[row[near[first]], :m] = np.log1p(np.add.reduceat(values.astype(np.float64) ** 2, first))
        return row[near[head]], np.maximum.reduceat(values, head), often


@dataclass
class Model:
    marks: Landmarks
    whiten: np.ndarray  # landmarks x landmarks: the Nystroem map
    weight: np.ndarray
    bias: float
    text_weight: np.ndarray  # of the worst sentence's margin, the landmarks' repetitions and the length
    text_bias: float
    slope: float
    shift: float
    constant: float | None = None

    def margins(self, row: np.ndarray, values: np.ndarray, often: np.ndarray) -> np.ndarray:
        """The margins of texts from their sentences and repetitions."""
        worst = np.full(len(often), self.bias)
        np.maximum.at(worst, row, values @ self.whiten @ self.weight + self.bias)
        return np.concatenate([worst[:, None], often], 1) @ self.text_weight + self.text_bias

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -60, 60)))


def _svm(x: np.ndarray, y: np.ndarray, share: np.ndarray, cost: float = 10.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Weights and bias for the squared hinge loss, by Newton steps on the examples inside the margin."""
    a = np.concatenate([x, np.ones((len(x), 1))], 1)
    w = np.zeros(a.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        inside = y * (a @ w) < 1
        b = a[inside] * (cost * share[inside])[:, None]
        new = np.linalg.solve(ridge + b.T @ a[inside], b.T @ y[inside])
        if np.abs(new - w).max() < 1e-8:
            break
        w = new if _ < 5 else (w + new) / 2
    return w[:-1], float(w[-1])


def _calibrated(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the probability, by Newton steps on the logistic loss of smoothed labels."""
    one, none = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (one + 1) / (one + 2), 1 / (none + 2))
    a = np.stack([margin, np.ones(len(margin))], 1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -60, 60)))
        w = w - np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-6 * np.eye(2), a.T @ (p - target) + 1e-6 * w)
        w = np.clip(w, [-50, -200], [50, 200])
    return float(w[0]), float(w[1])


def landmark_words(texts: list[str], y: np.ndarray, most: int = LANDMARKS, cover: int = 4) -> list[bytes]:
    """Tokens and beginnings of tokens, each the one that tells most (by the log likelihood ratio)
    about the label of the toxic texts that don't hold ``cover`` chosen ones yet. A word may tell
    by being there, or only by being there as often as one of ``TIMES``."""
    holders: dict[tuple[bytes, int], list[int]] = {}
    clean: Counter[tuple[bytes, int]] = Counter()
    for i in np.argsort(y <= 0, kind="stable").tolist():  # toxic texts first
        buf, s, e, _, _ = tokens(pa.array([texts[i]]))
        data = buf.tobytes()
        held: Counter[bytes] = Counter()
        for word, n in Counter(data[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True) if b - a >= ORDER).items():
            for k in range(ORDER, min(len(word), LONGEST) + 1):
                held[word[:k]] += n
        for word, n in held.items():
            for times in TIMES:
                if n >= times and y[i] > 0:
                    holders.setdefault((word, times), []).append(i)
                elif n >= times and (word, times) in holders:
                    clean[word, times] += 1
    one, none = int((y > 0).sum()), int((y <= 0).sum())
    least = max(2 if one >= 20 else 1, 0.01 * one)
    words = [w for w, h in holders.items() if len(h) >= least and len(h) * none > clean[w] * one]
    if not words:
        return []
    owner = np.repeat(np.arange(len(words)), [len(holders[w]) for w in words])
    text = np.concatenate([holders[w] for w in words])
    neg = np.array([clean[w] for w in words], float)
    length = np.array([len(w) for w, _ in words])
    left = np.full(len(texts), cover)
    out: list[bytes] = []
    while len(out) < most:
        pos = np.bincount(owner, left[text] > 0, len(words))
        total = max(1, int(((left > 0) & (y > 0)).sum()))
        share = (pos + neg) / (total + none)
        gain = pos * np.log(np.maximum(pos, 1e-9) / (total * share + 1e-9)) + neg * np.log(np.maximum(neg, 1e-9) / (none * share + 1e-9))
        gain[(pos < least) | (pos * none <= neg * total)] = 0
        best = max(range(len(words)), key=lambda i: (round(gain[i], 6), length[i], words[i]))
        if gain[best] <= LEAST_GAIN:
            break
        word = words[best][0]
        out.append(word)
        left[text[owner == best]] -= 1
        # Nor those that begin with it, or with which it begins.
        akin = np.array([w.startswith(word) or word.startswith(w) for w, _ in words])
        kept = ~akin[owner]
        owner, text = owner[kept], text[kept]
    return out


def fit(texts: list[str], toxic: list[int], rounds: int = 4) -> Model:
    """Fit on texts with labels 0 or 1."""
    y = np.where(np.array(toxic) == 1, 1.0, -1.0)
    empty = Landmarks([])
    if not len(y) or (y > 0).all() or (y <= 0).all():
        return Model(empty, np.zeros((0, 0)), np.zeros(0), 0, np.zeros(2), 0, 0, 0, float((y > 0).mean()) if len(y) else 0.0)
    marks = Landmarks(landmark_words(texts, y))
    row, values, often = [], [], []
    feat = Featuriser(marks)
    for a in range(0, len(texts), 256):
        r, v, o = feat.parts(pa.array(texts[a : a + 256]))
        row.append(r + a)
        values.append(v)
        often.append(o)
    row, values, often = np.concatenate(row), np.concatenate(values), np.concatenate(often)
    # A sentence without any similar token, for each text.
    row = np.concatenate([row, np.arange(len(texts))])
    values = np.concatenate([values, np.zeros((len(texts), len(marks.words)))])
    gram = np.zeros((len(marks.words),) * 2)
    ends = np.cumsum(marks.size)
    token, mark, value = marks.values(np.frombuffer(b"".join(marks.words), np.uint8), ends - marks.size, ends)
    gram[token, mark] = value
    size, vectors = np.linalg.eigh((gram + gram.T) / 2)
    whiten = vectors / np.sqrt(np.maximum(size, 0.05))
    x = values @ whiten
    best = values.max(1, initial=0) - 0.9
    worst = np.zeros(len(row), bool)  # of clean texts, the sentences that have scored highest
    for _ in range(rounds):
        order = np.lexsort((-best, row))
        head = order[np.concatenate([[True], row[order][1:] != row[order][:-1]])]
        witness = best > 0
        witness[head] = True
        worst[head[y[row[head]] < 0]] = True
        use = np.flatnonzero((y[row] < 0) | witness)
        label = y[row[use]]
        share = np.where(label > 0, 1 / (label > 0).sum(), 1 / (label < 0).sum() + worst[use] / worst.sum()) * 100
        weight, bias = _svm(x[use], label, share)
        best = x @ weight + bias
    worst = np.full((len(texts), 1), -np.inf)
    np.maximum.at(worst[:, 0], row, best)
    x = np.concatenate([worst, often], 1)
    text_weight, text_bias = _svm(x, y, np.where(y > 0, 1 / (y > 0).sum(), 1 / (y < 0).sum()) * 100)
    slope, shift = _calibrated(x @ text_weight + text_bias, y)
    return Model(marks, whiten, weight, bias, text_weight, text_bias, slope, shift)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on labelled documents outside the held-out fold; labels that repeat count by their majority."""
    marked = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        (F.avg(F.col("toxic").cast("double")) >= 0.5).cast("int").alias("toxic")
    ).where(~held_out(F.col("doc_id")))
    number = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}  # two rows
    share = F.when(F.col("toxic") == 1, SAMPLE / number.get(1, 1)).otherwise(SAMPLE / number.get(0, 1))
    sample = marked.where(unit_hash(F.col("doc_id"), 6) < share)
    # About twice SAMPLE ids, whatever the input: small enough to send everywhere, so that no text is shuffled to find them.
    rows = texts(docs).where("text is not null").join(F.broadcast(sample), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    some = sorted((r["text"], r["toxic"]) for r in rows.collect())  # about twice SAMPLE documents
    return fit([t for t, _ in some], [y for _, y in some])


_FEATURISER: list = []


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        if not _FEATURISER or _FEATURISER[0] is not model:
            _FEATURISER[:] = [model, Featuriser(model.marks)]
        for batch in batches:
            for some in T.slices(batch):
                if model.constant is not None:
                    p = np.full(some.num_rows, model.constant)
                else:
                    p = model.probability(model.margins(*_FEATURISER[1].parts(some.column("text"))))
                yield pa.record_batch([some.column("doc_id"), pa.array(p, pa.float64())], ["doc_id", "score"])

    return texts(docs).mapInArrow(judge, "doc_id long, score double")
