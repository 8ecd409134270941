"""Token files of directly addressable codes.

An id is split into chunks of 8 bits. Level 0 holds the low chunk of every id, level 1 the next chunk
of those ids that have one, and so on. Each level but the last has a bitmap, bit i set if element i
goes on in the next level, and a rank directory with the number of set bits before every 512th. The
place of an id in the next level is the rank of its bit, so any token is read with a few array reads
and without decoding a block.

A file is a Parquet table of blocks in ascending document order: ``part`` and ``first`` (ids of the
part before the block), the documents' ids and lengths, and ``codes``, the bytes below.

    bytes     0..3    "DAC1"
    4..7              number of levels
    8..               number of elements of each level, 8 bytes each
    per level         chunks; for all but the last: bitmap, padded to 64 bytes, and 4-byte ranks

Defined results: a null or empty text has the end id alone. Null doc_ids come first; rows that repeat a
doc_id are ordered by text and each has its own ids. No rows: an empty file. Extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelrank.llm.frames import blocks, in_small_batches
from reelrank.llm.tokens import Encoder, Scheme, in_parts

MAGIC = b"DAC1"
RANK_BITS = 512
#: Ids after which a block is closed; a block holds whole documents.
BLOCK_IDS = 1 << 18
#: Documents of one part (file).
PART_DOCS = 8192


def encoded(ids: np.ndarray) -> bytes:
    """The codes of an array of unsigned 32-bit ids."""
    rest, sizes, body = ids.astype(np.uint32), [], []
    while True:
        sizes.append(len(rest))
        body.append((rest & 0xFF).astype(np.uint8).tobytes())
        goes_on = rest > 0xFF
        rest = rest[goes_on] >> 8
        if not len(rest):
            break
        padded = np.zeros(-(-len(goes_on) // RANK_BITS) * RANK_BITS, dtype=bool)
        padded[: len(goes_on)] = goes_on
        counts = padded.reshape(-1, RANK_BITS).sum(axis=1)
        body.append(np.packbits(padded, bitorder="little").tobytes())
        body.append((np.cumsum(counts) - counts).astype("<u4").tobytes())
    return MAGIC + struct.pack(f"<I{len(sizes)}Q", len(sizes), *sizes) + b"".join(body)


class Codes:
    """Reads encoded ids: ``at(i)`` one of them, ``all()`` the whole array."""

    def __init__(self, raw: bytes) -> None:
        if raw[:4] != MAGIC:
            raise ValueError("not a block of directly addressable codes")
        (levels,) = struct.unpack_from("<I", raw, 4)
        sizes = struct.unpack_from(f"<{levels}Q", raw, 8)
        at = 8 + 8 * levels
        self.chunks, self.bits, self.ranks = [], [], []
        for level, n in enumerate(sizes):
            self.chunks.append(np.frombuffer(raw, np.uint8, n, at))
            at += n
            if level < levels - 1:
                groups = -(-n // RANK_BITS)
                self.bits.append(np.frombuffer(raw, np.uint8, groups * RANK_BITS // 8, at))
                at += groups * RANK_BITS // 8
                self.ranks.append(np.frombuffer(raw, "<u4", groups, at))
                at += 4 * groups

    def __len__(self) -> int:
        return len(self.chunks[0])

    def at(self, i: int) -> int:
        value = int(self.chunks[0][i])
        for level, (bits, ranks) in enumerate(zip(self.bits, self.ranks, strict=True)):
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            start = i // RANK_BITS * (RANK_BITS // 8)
            before = int(np.bitwise_count(bits[start : i >> 3]).sum())
            before += (int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
            i = int(ranks[i // RANK_BITS]) + before
            value |= int(self.chunks[level + 1][i]) << 8 * (level + 1)
        return value

    def all(self) -> np.ndarray:
        values = self.chunks[0].astype("<u4")
        places = np.arange(len(values))
        for level, bits in enumerate(self.bits):
            goes_on = np.unpackbits(bits, count=len(self.chunks[level]), bitorder="little").astype(bool)
            places = places[goes_on]
            values[places] |= self.chunks[level + 1].astype("<u4") << (8 * (level + 1))
        return values


FILE = "part int, block int, first long, doc_ids array<long>, lengths array<long>, codes binary"


def write(docs: DataFrame, path: str, tokenizer: str, scheme: Scheme, end_id: int) -> None:
    """Token files of ``docs`` (doc_id, text) below ``path``, one per range of doc_id."""

    def blocks_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = Encoder(tokenizer, scheme), np.array([end_id], dtype="<u4").tobytes()
        part, block, first = TaskContext.get().partitionId(), 0, 0
        doc_ids: list = []
        held: list[bytes] = []

        def closed() -> pd.DataFrame:
            nonlocal block, first
            ids = np.frombuffer(b"".join(held), dtype="<u4")
            row = [part, block, first, list(doc_ids), [len(h) // 4 for h in held], encoded(ids)]
            block, first = block + 1, first + len(ids)
            doc_ids.clear()
            held.clear()
            return pd.DataFrame([row], columns=["part", "block", "first", "doc_ids", "lengths", "codes"])

        size = 0
        for batch in batches:
            texts = batch["text"].tolist()
            keys = [None if pd.isna(k) else int(k) for k in batch["doc_id"]]
            for span in in_parts(texts):
                for key, raw in zip(keys[span], encoder.ids(texts[span]), strict=True):
                    doc_ids.append(key)
                    held.append(raw + end)
                    size += len(raw) // 4 + 1
                    if size >= BLOCK_IDS:
                        yield closed()
                        size = 0
        if held:
            yield closed()

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = blocks(kept.count(), PART_DOCS)
    ordered = kept.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    in_small_batches(ordered).mapInPandas(blocks_of, FILE).write.option("compression", "uncompressed").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the files."""

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                ids = Codes(row.codes).all()
                lengths = np.asarray(row.lengths, dtype=np.int64)
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends, lengths, strict=True)]
                doc_ids = pd.array([None if pd.isna(k) else int(k) for k in row.doc_ids], dtype="Int64")
                yield pd.DataFrame(
                    {"part": row.part, "doc_id": doc_ids, "local": row.first + ends - lengths, "n_tokens": lengths, "ids_crc32": crc}
                )

    stored = spark.read.schema(FILE).parquet(path)
    # One row per part, so this window and what is joined stay small.
    sizes = stored.select("part", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
    sizes = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    made = stored.mapInPandas(documents, "part int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return made.join(bases, "part").select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


__all__ = ["Codes", "encoded", "read", "write"]
