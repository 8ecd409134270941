"""Vector best-fit packing of tokenised documents into sequences.

A document is cut into pieces of at most the sequence length. A piece is a vector (tokens, one
document, attention cost = tokens squared) and a sequence has a capacity in each of the three. Pieces
are dealt by hash into groups of bounded size and each group is packed in a task: longest piece first,
into the open sequence that fits in every capacity and scores best, by the weighted norm of what would
be left (``norm``) or by the weighted dot product of piece and room (``dot``). A group leaves a sequence
or two partly filled, so the total stays within about a thousandth of one packing over all pieces.

Defined results: a null or empty text is a document of the end id alone. Repeated rows are packed
each by itself. A null doc_id is a document like any other. No rows: no pieces. Extra columns are ignored.
Pieces longer than a capacity allows get a sequence of their own (cannot happen with cuts at that length).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.frames import blocks, in_small_batches
from reelrank.llm.tokens import Encoder, Scheme, in_parts
from reelrank.session import materialize

#: Words remembered by a worker; fewer than elsewhere, since earlier stages have filled the executors' memory.
REMEMBERED = 500_000
#: Pieces packed together in one task.
GROUP = 8192


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds at most, the weight of each dimension, and the rule that selects."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"


def pieces(docs: DataFrame, tokenizer: str, scheme: Scheme, end_id: int, size: int, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids): every document's ids and ``end_id``, cut at ``size``."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = Encoder(tokenizer, scheme, REMEMBERED), np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            texts, doc_ids = batch["text"].tolist(), batch["doc_id"].array
            for part in in_parts(texts):
                rows: dict[str, list] = {"at": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
                for at, raw in enumerate(encoder.ids(texts[part])):
                    raw += end
                    for k, start in enumerate(range(0, len(raw), 4 * size)):
                        own = raw[start : start + 4 * size]
                        rows["at"].append(at + part.start)
                        rows["piece"].append(k)
                        rows["start"].append(start // 4)
                        rows["length"].append(len(own) // 4)
                        rows["ids_crc32"].append(zlib.crc32(own))
                        rows["ids"].append(np.frombuffer(own, dtype="<u4").astype(np.int64) if keep_ids else None)
                at = rows.pop("at")
                if not keep_ids:
                    rows.pop("ids")
                yield pd.DataFrame({"doc_id": doc_ids.take(at), **rows})

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return in_small_batches(kept).mapInPandas(cut, schema + (", ids array<long>" if keep_ids else ""))


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every piece; see the module."""
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], dtype=float)
    weights = np.array(capacity.weights)
    room = np.empty((3, len(lengths)))  # of each sequence, as a share of its capacity
    used = np.zeros(len(lengths), dtype=np.int64)
    number, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    alive = np.empty(0, dtype=np.int64)  # sequences that can take the shortest piece still
    opened, least = 0, lengths.min(initial=0)
    for turn, i in enumerate(np.argsort(-lengths, kind="stable")):
        n = float(lengths[i])
        piece = np.array([n, 1.0, n * n]) / full
        if turn % 256 == 0 and turn:
            alive = alive[room[0, alive] * full[0] >= least - 0.5]
        left = room[:, alive] - piece[:, None]
        fits = np.flatnonzero((left > -1e-9).all(axis=0))
        if len(fits):
            if capacity.rule == "dot":
                chosen = fits[np.argmax((weights * piece) @ room[:, alive[fits]])]
            else:
                chosen = fits[np.argmin(weights @ left[:, fits] ** 2)]
            to = alive[chosen]
            room[:, to] -= piece
        else:
            to, opened = opened, opened + 1
            room[:, to] = 1.0 - piece
            alive = np.append(alive, to)
        number[i], offset[i] = to, used[to]
        used[to] += lengths[i]
    return number, offset


def _packed(capacity: Capacity) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ignore_index=True)
        number, offset = best_fit(group["length"].to_numpy(), capacity)
        group["sequence_id"] = group.pop("_group") * 2**32 + number
        group["offset"] = offset
        return group

    return pack


def pack(cut: DataFrame, capacity: Capacity, group: int = GROUP) -> DataFrame:
    """``cut`` (see ``pieces``, without ids) with sequence_id and offset. Reads ``cut`` twice: store it first."""
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    n = blocks(cut.count(), group)
    dealt = cut.select(*keys, F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n)).alias("_group"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return dealt.groupBy("_group").applyInPandas(_packed(capacity), schema)


def sequences(cut: DataFrame, packed: DataFrame) -> DataFrame:
    """The training rows: sequence_id, ids, with the pieces (``cut`` with ids) in their places."""
    keys = ["doc_id", "piece", "ids_crc32"]
    placed = cut.join(packed.select(*keys, "sequence_id", "offset"), keys)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str, scheme: Scheme, end_id: int, capacity: Capacity) -> DataFrame:
    """Tokenise, cut and pack ``docs`` (doc_id, text)."""
    return pack(materialize(pieces(docs, tokenizer, scheme, end_id, capacity.tokens)), capacity)


__all__ = ["Capacity", "best_fit", "pack", "pack_documents", "pieces", "sequences"]
