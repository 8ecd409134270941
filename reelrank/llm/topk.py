"""Exact top-k search by exhaustive term-at-a-time accumulation.

Queries and candidates are cut into blocks and every query block meets every candidate block in one
task. There the candidates are turned into postings, a list of (candidate, weight) per component
("term"). A query row is sparse: for each of its non-zero terms the weighted postings are scattered
into a dense array of scores, one place per candidate of the block. A partition selection keeps k
candidates per query and block, and a window merges the blocks.

Defined results: vectors that are null, hold a null or non-finite component, or have no id
take no part. Vectors of different lengths are compared over the components they share. Rows that
repeat an id are one vector, the smallest by array order. Ties go to the smaller id. Fewer than k
candidates: all of them. Empty tables: no rows. Columns beside the two named are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelrank.llm.frames import blocks

CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 1024
#: Sums of products below this are exact in a double.
EXACT = float(2**53)


def quantized(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id``, ``v``: every component x as floor(scale * x), only vectors that are whole and finite."""
    x = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = x.where(F.col("id").isNotNull() & F.col("x").isNotNull() & finite)
    ints = whole.select("id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v"))
    return ints.groupBy("id").agg(F.min("v").alias("v"))


def postings(rows: list[np.ndarray]) -> tuple[list[tuple[np.ndarray | None, np.ndarray]], float]:
    """Per term the candidates that hold it and their weights (None: all of them), and the largest weight."""
    width = max((len(r) for r in rows), default=0)
    dense = np.zeros((width, len(rows)))
    for i, r in enumerate(rows):
        dense[: len(r), i] = r
    lists = []
    for weights in dense:
        held = np.flatnonzero(weights)
        # A list that covers half of the block is cheaper to add as it stands.
        lists.append((None, weights) if 2 * len(held) >= len(rows) else (held, weights[held]))
    return lists, float(np.abs(dense).max(initial=0.0))


def accumulate(query: np.ndarray, lists: list, scores: np.ndarray, room: np.ndarray) -> None:
    """Scatter the postings of each non-zero term of ``query`` into ``scores``, weighted."""
    scores.fill(0)
    for term in np.flatnonzero(query[: len(lists)]):
        held, weights = lists[term]
        if held is None:
            np.multiply(weights, query[term], out=room)
            scores += room
        else:
            scores[held] += weights * query[term]


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the lower place."""
    if len(scores) <= k:
        return np.arange(len(scores))
    bar = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > bar)
    return np.concatenate([above, np.flatnonzero(scores == bar)[: k - len(above)]])


def _search(k: int):
    def block(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        candidates = candidates.sort_values("id", ignore_index=True)
        ids = candidates["id"].to_numpy()
        rows = [np.asarray(v, dtype=np.int64) for v in candidates["v"]]
        lists, largest = postings(rows)
        scores, room = np.zeros(len(ids)), np.zeros(len(ids))
        for query_id, vector in zip(queries["id"], queries["v"], strict=True):
            query = np.asarray(vector, dtype=np.int64)
            if float(np.abs(query).sum()) * largest < EXACT:
                accumulate(query.astype(float), lists, scores, room)
                found = scores
            else:  # beyond a double's whole numbers
                found = np.array([sum(int(a) * int(b) for a, b in zip(query, r)) for r in rows], dtype=object)
            others = np.flatnonzero(ids != query_id)
            kept = others[best(found[others], k)] if len(others) < len(ids) else best(found, k)
            out["query_id"] += [query_id] * len(kept)
            out["vec_id"] += ids[kept].tolist()
            out["score"] += [int(s) for s in found[kept]]
        return pd.DataFrame(out).astype("int64")

    return block


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """The ``k`` candidates of highest inner product per query: query_id, rank, vec_id, score.

    Both frames hold ``id long, v array<long>``, ids unique. A candidate with the query's own id is
    left out.
    """
    across = blocks(queries.count(), QUERY_BLOCK)
    down = blocks(candidates.count(), CANDIDATE_BLOCK)

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        own_block = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias(own)
        return df.select("id", "v", own_block, F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other))

    left = dealt(queries, "_q", across, "_c", down).groupBy("_q", "_c")
    right = dealt(candidates, "_c", down, "_q", across).groupBy("_q", "_c")
    found = left.cogroup(right).applyInPandas(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    merged = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return merged.select("query_id", "rank", "vec_id", "score")


__all__ = ["quantized", "top_k"]
