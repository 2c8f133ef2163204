import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gridlake.llm import packing, token_files
from gridlake.llm.common import Stage
from gridlake.llm.tokens import WordEncoder, default_path


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_by_word_equals_the_library(tokenizer):
    rng = random.Random(1)
    chars = "aAbeéÉßΣσ İi'sST0١２#$<|endoftext|>́ \u0085 \n\t\x1c\x0b\U0001f4a5中ﬁ K.-"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["<|endoftext|> a <|ENDOFTEXT|>", None, ""]
    enc = WordEncoder(default_path())
    for _ in range(2):  # the second time all words are known
        ids, offs = enc.encode(pa.array(texts))
        for i, t in enumerate(texts):
            assert ids[offs[i] : offs[i + 1]].tolist() == ids_of(tokenizer, t)


@pytest.mark.parametrize("top", [1, 255, 256, 65536, 2**32])
@pytest.mark.parametrize("n", [0, 1, 511, 513, 3000])
def test_codes_round_trip(top, n):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    codes = token_files.Codes(token_files.encode_codes(ids))
    assert len(codes) == n and codes.all().tolist() == ids.tolist()
    assert [codes[i] for i in range(n)] == ids.tolist()


def test_files_hold_every_id_in_order(spark, odd_docs, no_docs, tokenizer):
    path = f"{Stage(spark, 'test').base}/files"
    token_files.write_tokens(odd_docs, path, default_path(), end_id=2, block_tokens=50)
    rows = sorted(odd_docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    whole, start = [], 0
    got = {}
    for r in token_files.read_documents(spark, path).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.n_tokens, r.ids_crc32))
    for r in rows:
        ids = [*ids_of(tokenizer, r.text), 2]
        assert (start, len(ids), crc(ids)) in got[r.doc_id]
        whole += ids
        start += len(ids)
    at = [0, 1, len(whole) - 1, len(whole) // 2, 17]
    places = spark.createDataFrame([(p,) for p in [*at, len(whole), -1]], "position long")
    assert dict(token_files.tokens_at(spark, path, places).collect()) == {p: whole[p] for p in at}
    empty = f"{Stage(spark, 'test').base}/files"
    token_files.write_tokens(no_docs, empty, default_path(), end_id=2)
    assert token_files.read_documents(spark, empty).count() == 0


@pytest.mark.parametrize("n", [0, 1, 50, 2000])
def test_histogram_is_packed_exactly(n):
    rng = np.random.default_rng(n)
    length = np.clip(rng.lognormal(4, 1, n).astype(int), 1, 256)
    count = np.bincount(length, minlength=257)
    used = np.zeros(257, int)
    sequences = 0
    for lengths, copies, times in packing.pack_histogram(count, rounds=100):
        assert (lengths * copies).sum() <= 256
        used[lengths] += copies * times
        sequences += times
    assert (used == count).all()
    assert sequences <= 1.05 * -(-int(length.sum()) // 256) + 1


def test_the_knapsack_finds_the_dearest_configuration():
    rng = np.random.default_rng(2)
    for _ in range(20):
        price = np.where(rng.random(13) < 0.6, rng.random(13), -1.0)
        best = [0.0] * 13
        for c in range(1, 13):
            best[c] = max([best[c - 1], *(best[c - k] + price[k] for k in range(1, c + 1) if price[k] > 0)])
        config = packing.best_configuration(price)
        assert sum(config) <= 12 and np.isclose(price[config].sum() if config else 0, best[12])


def test_packed_pieces_are_whole_and_gapless(spark, odd_docs, no_docs, tokenizer):
    rows = packing.pack(odd_docs, default_path(), capacity=64, with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert r.length == len(r.ids) // 4 <= 64 and r.ids_crc32 == zlib.crc32(r.ids) and r.start == 64 * r.piece
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= 64
    for r in odd_docs.dropDuplicates(["doc_id"]).collect():
        mine = sorted(by_doc[r.doc_id], key=lambda p: p.piece)
        mine = mine[:: 2 if r.doc_id == 1 else 1]
        assert b"".join(p.ids for p in mine) == np.array([*ids_of(tokenizer, r.text), 0], "<u4").tobytes()
    assert packing.pack(no_docs, default_path()).count() == 0


@pytest.mark.parametrize("doublings", [10, 11, 12])
def test_words_with_equal_sums_keep_their_own_ids(tokenizer, doublings):
    """Thue-Morse words, which every polynomial modulo 2**64 takes for each other."""
    a = "a"
    for _ in range(doublings):
        a += a.translate(str.maketrans("ab", "ba"))
    b = a.translate(str.maketrans("ab", "ba"))
    ids, offs = WordEncoder(default_path()).encode(pa.array([a, b, a]))
    for i, t in enumerate((a, b, a)):
        assert ids[offs[i] : offs[i + 1]].tolist() == ids_of(tokenizer, t)


def plain_best_fit(count):
    """Best-fit decreasing, piece by piece."""
    rooms = []
    for length in range(len(count) - 1, 0, -1):
        for _ in range(int(count[length])):
            fits = [i for i, r in enumerate(rooms) if r >= length]
            if fits:
                rooms[min(fits, key=lambda i: rooms[i])] -= length
            else:
                rooms.append(len(count) - 1 - length)
    return len(rooms)


LENGTHS = {
    "uniform": lambda rng, n: rng.integers(1, 2049, n),
    "lognormal": lambda rng, n: rng.lognormal(6.8, 0.5, n),
    "long tail": lambda rng, n: rng.lognormal(5, 1.3, n),
    "thirds": lambda rng, n: rng.integers(300, 1001, n),
    "halves": lambda rng, n: rng.integers(600, 1101, n),
}


@pytest.mark.parametrize("kind", LENGTHS)
def test_packing_is_never_worse_than_best_fit(kind):
    rng = np.random.default_rng(5)
    for n in (300, 20_000):
        lengths = np.clip(LENGTHS[kind](rng, n).astype(int), 1, 2048)
        count = np.bincount(lengths, minlength=2049)
        packed = packing.pack_histogram(count, rounds=60)
        used = np.zeros(2049, np.int64)
        for some, copies, times in packed:
            assert (some * copies).sum() <= 2048 and times > 0
            used[some] += copies * times
        assert (used == count).all()
        total, best = sum(t for _, _, t in packed), sum(t for _, _, t in packing.best_fit(count))
        assert -(-int(lengths.sum()) // 2048) <= total <= best
        if n == 300:
            assert best <= plain_best_fit(count) + 1
