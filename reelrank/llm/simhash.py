"""SimHash near-duplicates with sharded vantage-point trees.

Fingerprints that differ in at most ``bits`` of 64 bits differ in at most ``bits // 4`` of one of their
four 16-bit quarters. For each quarter a vantage-point tree divides the fingerprints by the Hamming
distance of their quarter to a vantage point: within the node's radius to the left, beyond it to the
right. A fingerprint has a home, one leaf of each tree, and also visits the leaves on the other side of a
boundary it lies too near to, which the triangle inequality decides. A leaf is a shard: its task grows
the tree on down to small nodes, prunes branches by the same bound, and compares whole fingerprints
there, so the pairs found are exact and complete.

The upper trees are drawn from a bounded sample; where they cut decides the size of the shards and
never a result. Leaves with many members are cut into chunks that visit each other, chunks with many
visitors are cut again, so no task holds an unbounded group. A task joins the pairs it finds at once and
hands on a link from each member to the first of its group, never all pairs.

Defined results: a null text is an empty one; texts without words have fingerprint zero and link like any
other. Rows that repeat a doc_id are placed each by its own text. Rows without a doc_id keep their fingerprint,
have no component and link nothing. No rows: no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.components import components
from reelrank.llm.frames import blocks, in_small_batches, sent
from reelrank.session import materialize

SEED = 42
#: Words of a shingle and bits that near duplicates may differ in.
WIDTH = 4
BITS = 4
QUARTERS = 4
#: Fingerprints drawn for the upper trees, members of a leaf aimed at, levels of an upper tree at most.
SAMPLE = 16_384
LEAF = 4096
DEPTH = 10
#: Members of a shard and visitors of a shard at most.
CHUNK = 8192
VISITORS = 32_768
#: A node of a task's tree with fewer members is compared whole; cells compared at once.
SMALL = 24
CELLS = 1 << 17
#: Shingles counted at once.
STEP = 1 << 16


def fingerprint(text: str | None, width: int) -> int:
    """Unsigned 64-bit SimHash of ``width``-word shingles, A-Z lower-cased, words cut at ASCII white space."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)))) if len(words) > width else iter([b" ".join(words)])
    n = max(1, len(words) - width + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8", count=n)
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, n, STEP):
        part = hashes[i : i + STEP].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = np.array([fingerprint(t, width) for t in batch["text"]], dtype=np.uint64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "fp": made.view(np.int64)})

    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return in_small_batches(kept).mapInPandas(run, "doc_id long, fp long")


def _quarter(fps: np.ndarray, q: int) -> np.ndarray:
    return (fps >> np.uint64(16 * q) & np.uint64(0xFFFF)).astype(np.uint16)


def _split(distances: np.ndarray) -> int:
    """A radius near the median that leaves both sides with something; -1 where none does."""
    radius, low, high = int(np.median(distances)), int(distances.min()), int(distances.max())
    return -1 if low == high else min(max(radius, low), high - 1)


def plant(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and radii of a whole binary tree over the quarters in ``sample``."""
    rng = np.random.default_rng(SEED)
    vantage, radius = np.zeros(2**depth - 1, dtype=np.uint16), np.full(2**depth - 1, 16)
    held = {0: sample}
    for node in range(2**depth - 1):
        own = held.pop(node, sample[:0])
        left, right = own, own[:0]
        if len(own) > 1:
            vantage[node] = rng.choice(own)
            distance = np.bitwise_count(own ^ vantage[node])
            cut = _split(distance)
            if cut >= 0:
                radius[node] = cut
                left, right = own[distance <= cut], own[distance > cut]
        held[2 * node + 1], held[2 * node + 2] = left, right
    return vantage, radius


def home(quarters: np.ndarray, tree: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The leaf of each quarter."""
    vantage, radius = tree
    node = np.zeros(len(quarters), dtype=np.int64)
    for _ in range(int(np.log2(len(vantage) + 1))):
        node = 2 * node + 1 + (np.bitwise_count(quarters ^ vantage[node]) > radius[node])
    return node - len(vantage)


def visits(quarters: np.ndarray, tree: tuple[np.ndarray, np.ndarray], bound: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every leaf that can hold a quarter within ``bound``: the triangle inequality prunes the rest."""
    vantage, radius = tree
    row, node = np.arange(len(quarters)), np.zeros(len(quarters), dtype=np.int64)
    for _ in range(int(np.log2(len(vantage) + 1))):
        distance = np.bitwise_count(quarters[row] ^ vantage[node]).astype(np.int64)
        left, right = distance <= radius[node] + bound, distance > radius[node] - bound
        row = np.concatenate([row[left], row[right]])
        node = np.concatenate([2 * node[left] + 1, 2 * node[right] + 2])
    return row, node - len(vantage)


class _Groups:
    """Union of the points of one shard; every point ends at the least point of its group."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def search(fps: np.ndarray, members: int, q: int, bits: int) -> np.ndarray:
    """Groups of one shard: the first ``members`` fingerprints live there, the others visit.

    Members are compared with members and visitors, visitors with members only.
    """
    rng, bound, part = np.random.default_rng(SEED), bits // QUARTERS, _quarter(fps, q)
    groups = _Groups(len(fps))
    todo = [(np.arange(members), np.arange(len(fps)))]
    while todo:
        m, v = todo.pop()
        if not len(m) or not len(v):
            continue
        cut = -1
        if len(m) > SMALL:
            vantage = part[m[rng.integers(len(m))]]
            of_m = np.bitwise_count(part[m] ^ vantage).astype(np.int64)
            cut = _split(of_m)
        if cut >= 0:
            of_v = np.bitwise_count(part[v] ^ vantage).astype(np.int64)
            inside = of_m <= cut
            todo.append((m[inside], v[of_v <= cut + bound]))
            todo.append((m[~inside], v[of_v > cut - bound]))
            continue
        step = max(1, CELLS // len(m))
        for i in range(0, len(v), step):
            own = v[i : i + step]
            near = np.bitwise_count(fps[m][:, None] ^ fps[own][None, :]) <= bits
            a, b = np.nonzero(near)
            groups.join(m[a], own[b])
    return groups.root


def _links(bits: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["visitor", "fp"], ignore_index=True)
        fps = shard["fp"].to_numpy(dtype=np.int64).view(np.uint64)
        q = int(shard["shard"].iloc[0]) >> 48
        root = search(fps, int((~shard["visitor"]).sum()), q, bits)
        moved = np.flatnonzero(root != np.arange(len(root)))
        signed = fps.view(np.int64)
        return pd.DataFrame({"a": signed[moved], "b": signed[root[moved]]})

    return run


def link(nodes: DataFrame, bits: int) -> DataFrame:
    """Edges (a, b) between the fingerprints of ``nodes`` (fp, unique) that connect all near pairs."""
    count = nodes.count()
    depth = min(DEPTH, int(np.ceil(np.log2(max(1.0, count / LEAF)))))
    drawn = nodes.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).select("fp").toPandas()["fp"]
    sample = drawn.to_numpy(dtype=np.int64).view(np.uint64)
    trees = [plant(_quarter(sample, q), depth) for q in range(QUARTERS)]
    bound = bits // QUARTERS

    def count_homes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            for q, tree in enumerate(trees):
                leaf, n = np.unique(home(_quarter(fps, q), tree), return_counts=True)
                yield pd.DataFrame({"q": q, "leaf": leaf, "n": n})

    sizes = nodes.select("fp").mapInPandas(count_homes, "q int, leaf int, n long").groupBy("q", "leaf").agg(F.sum("n"))
    chunks = np.ones((QUARTERS, 2**depth), dtype=np.int64)
    for q, leaf, n in sizes.collect():  # at most four trees of 2**DEPTH leaves
        chunks[q, leaf] = blocks(n, CHUNK)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy(dtype=np.int64).view(np.uint64)
            spread = (fps * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            for q, tree in enumerate(trees):
                own_leaf = home(_quarter(fps, q), tree)
                own = (own_leaf << 32) + spread % chunks[q, own_leaf]
                yield _rows(q, own, False, fps)
                row, leaf = visits(_quarter(fps, q), tree, bound)
                times = chunks[q, leaf]
                row, leaf = np.repeat(row, times), np.repeat(leaf, times)
                chunk = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                to = (leaf << 32) + chunk
                once = to < own[row]  # of two homes only one visits the other
                yield _rows(q, to[once], True, fps[row[once]])

    dealt = nodes.select("fp").mapInPandas(deal, "shard long, visitor boolean, fp long")
    # Shards with many visitors are cut by visitor; their members go to every part.
    crowded = dealt.where("visitor").groupBy("shard").agg(F.count(F.lit(1)).alias("_n"))
    crowded = crowded.where(F.col("_n") > VISITORS).select("shard", F.ceil(F.col("_n") / VISITORS).cast("int").alias("_parts"))
    dealt = dealt.join(crowded, "shard", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    visiting = F.array(F.pmod(F.xxhash64("fp"), F.col("_parts")).cast("int"))
    living = F.sequence(F.lit(0), F.col("_parts") - 1)
    dealt = dealt.withColumn("part", F.explode(F.when(F.col("visitor"), visiting).otherwise(living))).drop("_parts")
    return dealt.groupBy("shard", "part").applyInPandas(_links(bits), "a long, b long")


def _rows(q: int, shard: np.ndarray, visitor: bool, fps: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"shard": (q << 48) + shard, "visitor": visitor, "fp": fps.view(np.int64)})


def near_duplicates(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id reachable over fingerprints at most ``bits`` apart."""
    prints = materialize(fingerprints(docs, width))
    known = prints.where(F.col("doc_id").isNotNull())
    nodes = materialize(known.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(link(nodes, bits)).withColumnRenamed("node", "fp")
    joined = nodes.join(found, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    smallest = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = joined.join(smallest, "component").select("fp", "component_id")
    return prints.join(placed, "fp", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def keep_one(docs: DataFrame, width: int, bits: int) -> DataFrame:
    """``docs`` with the document of smallest id of each component.

    Rows without a doc_id stay; rows that repeat a doc_id stay or go together.
    """
    found = near_duplicates(docs, width, bits).where(F.col("doc_id").isNotNull())
    stays = F.max(F.col("doc_id") == F.col("component_id"))
    gone = materialize(found.groupBy("doc_id").agg(stays.alias("stays")).where("not stays").select("doc_id"))
    return docs.join(sent(gone, gone.count()), "doc_id", "left_anti").select(*docs.columns)


def hex_digits(fp: Column) -> Column:
    """A signed long as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


__all__ = ["fingerprint", "fingerprints", "hex_digits", "keep_one", "near_duplicates", "search"]
