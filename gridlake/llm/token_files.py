"""Token ids in directly addressable codes (operator 5).

An id is split into chunks of 8 bits, lowest first. Level k holds the k-th
chunk of every id that has one, and a bitmap that says which of them go on at
level k + 1. A rank directory (ones before each 512 bits) finds an id's place
at the next level, so any token is read without decoding its neighbours.

A file set is a folder of Parquet files with one block per row: whole
documents in ascending doc_id order, their ids and offsets, and the coded
tokens in one binary value. Spark's committer writes it, so a lost executor or
a repeated task leaves no part of a block behind.

Block, little-endian: ``DAC1``, uint32 number of levels, then for each level
uint64 n, n chunk bytes, ceil(n / 8) bitmap bytes (lowest bit first),
uint64 d, d uint64 directory entries.

Null or empty texts have the end id alone; a null doc_id sorts first; rows
that repeat are written as often as they occur; an empty table gives no block.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import text as T
from .common import texts
from .tokens import ENCODE_BYTES, encoder

MAGIC = b"DAC1"
RANK_BITS = 512
BLOCK_SCHEMA = (
    "part int, block int, n_docs long, n_tokens long, doc_ids array<long>, starts array<long>, codes binary"
)


def encode_codes(ids: np.ndarray) -> bytes:
    """The block of a sequence of unsigned 32-bit ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        step = RANK_BITS // 8
        ones = np.add.reduceat(np.bitwise_count(bits).astype(np.uint64), np.arange(0, len(bits), step)) if len(bits) else bits.astype(np.uint64)
        ranks = np.cumsum(ones, dtype=np.uint64) - ones
        levels.append(
            struct.pack("<Q", len(rest)) + (rest & 0xFF).astype(np.uint8).tobytes() + bits.tobytes()
            + struct.pack("<Q", len(ranks)) + ranks.astype("<u8").tobytes()
        )
        if not more.any():
            return MAGIC + struct.pack("<I", len(levels)) + b"".join(levels)
        rest = rest[more] >> 8


class Codes:
    """A block that is read: ``[i]`` for one token, ``all()`` for the whole sequence."""

    def __init__(self, block: bytes):
        if block[:4] != MAGIC:
            raise ValueError("not a block of directly addressable codes")
        self.levels, at = [], 8
        for _ in range(struct.unpack_from("<I", block, 4)[0]):
            n = struct.unpack_from("<Q", block, at)[0]
            at += 8
            chunks = np.frombuffer(block, np.uint8, n, at)
            bits = np.frombuffer(block, np.uint8, (n + 7) // 8, at + n)
            at += n + (n + 7) // 8
            d = struct.unpack_from("<Q", block, at)[0]
            self.levels.append((chunks, bits, np.frombuffer(block, "<u8", d, at + 8)))
            at += 8 + 8 * d

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        value = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * k)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            first = i // RANK_BITS * (RANK_BITS // 8)
            before = int(np.bitwise_count(bits[first : i >> 3]).sum())
            i = int(ranks[i // RANK_BITS]) + before + int(bits[i >> 3] & ((1 << (i & 7)) - 1)).bit_count()
        return value

    def all(self) -> np.ndarray:
        at = np.arange(len(self))
        out = np.zeros(len(self), np.uint32)
        for k, (chunks, bits, _) in enumerate(self.levels):
            out[at] |= chunks.astype(np.uint32) << np.uint32(8 * k)
            at = at[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return out


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, block_tokens: int = 1 << 20) -> None:
    """Write the ids of every text, each with ``end_id`` after it, as a file set at ``path``."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part, block = encoder(tokenizer), TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        starts: list[int] = []
        doc_ids: list = []
        n = 0

        def packed() -> pa.RecordBatch:
            codes = encode_codes(np.concatenate(ids))
            row = [[part], [block], [len(doc_ids)], [n], [doc_ids], [starts], [codes]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            names = ["part", "block", "n_docs", "n_tokens", "doc_ids", "starts", "codes"]
            return pa.record_batch([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for some in T.slices(batch, budget=ENCODE_BYTES, trim=False):
                got, offs = enc.encode(some.column("text"))
                for doc, a, b in zip(some.column("doc_id").to_pylist(), offs[:-1].tolist(), offs[1:].tolist(), strict=True):
                    starts.append(n)
                    doc_ids.append(doc)
                    ids += [got[a:b], np.array([end_id], np.uint32)]
                    n += b - a + 1
                    if n >= block_tokens:
                        yield packed()
                        ids, starts, doc_ids, n, block = [], [], [], 0, block + 1
        if doc_ids:
            yield packed()

    ordered = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(blocks, BLOCK_SCHEMA).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks with ``block_start``, the number of tokens before each.

    Sums by part come first, so the one ordered sum over the whole set is over
    as many rows as there are files.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    sizes = blocks.select("part", "block", "n_tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")
    )
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(parts, "part").select(
        "part", "block", (F.col("part_start") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("block_start")
    )
    return blocks.join(starts, ["part", "block"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document of a file set; ids: little-endian uint32."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = Codes(r["codes"]).all().astype("<u4")
                cuts = [*r["starts"], r["n_tokens"]]
                data = [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.record_batch(
                    [
                        pa.array(r["doc_ids"], pa.int64()),
                        pa.array([r["block_start"] + a for a in r["starts"]], pa.int64()),
                        pa.array([len(x) // 4 for x in data], pa.int64()),
                        pa.array([zlib.crc32(x) for x in data], pa.int64()),
                        pa.array(data, pa.binary()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                )

    return read_blocks(spark, path).mapInArrow(
        documents, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    )


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """(position, id): single tokens by their place in the whole set, each read without decoding its block."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                codes = Codes(r["codes"])
                yield pa.record_batch(
                    [pa.array(r["at"], pa.int64()), pa.array([codes[p - r["block_start"]] for p in r["at"]], pa.int64())],
                    ["position", "id"],
                )

    blocks = read_blocks(spark, path)
    places = positions.select(F.col("position").cast("long").alias("position")).distinct()
    inside = (F.col("position") >= F.col("block_start")) & (F.col("position") < F.col("block_start") + F.col("n_tokens"))
    wanted = places.join(blocks.select("part", "block", "block_start", "n_tokens"), inside).groupBy("part", "block").agg(
        F.collect_list("position").alias("at")  # at most the tokens of a block
    )
    return blocks.join(wanted, ["part", "block"]).select("block_start", "codes", "at").mapInArrow(
        found, "position long, id long"
    )
