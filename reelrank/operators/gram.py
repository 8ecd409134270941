"""Sums of user weights over the common users of all pairs of items, and the best partners of every item.

S(i, j) is the sum of q_u over the users u that have both i and j: row i of it is the sum of the histories of the users of
i, each times q_u. Items are cut into blocks. A user's history goes once, as one packed array, to every block in which
the user has an item: as many copies of a log row as the user has blocks, so never more than there are blocks and
never more than the user has items. No pair ever enters a shuffle. A task holds the sums of its block, adds up histories
as they arrive, and in the end cuts every row to its K best partners: the rows it hands on are the result.

Blocks are cut by measured numbers. An item with users u needs at most least(items, sum of n_u) sums and exactly the sum of n_u
products; blocks are as many as keep both within ``Sizes``. An item with more products than a task should do (a *hot* one)
has tasks of its own, which share out its users; their rows are added up afterwards.

q_u are whole numbers, so the sums do not depend on the order in which histories arrive.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelrank.session import materialize


@dataclass(frozen=True)
class Sizes:
    """Sums a task holds, products it does in all, and products it has in memory at a time."""

    sums: int = 8_000_000
    products: int = 400_000_000
    at_once: int = 2_000_000


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start .. start + length - 1 of all ranges, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


class SparseSums:
    """Whole-number sums by code; new values wait until enough are there to be merged in."""

    def __init__(self, waiting: int) -> None:
        self.codes, self.values = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.more: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting, self.most = 0, waiting

    def add(self, codes: np.ndarray, values: np.ndarray) -> None:
        self.more.append((codes, values))
        self.waiting += len(codes)
        if self.waiting >= max(self.most, len(self.codes) // 2):
            self.settle()

    def settle(self) -> None:
        if not self.more:
            return
        codes = np.concatenate([self.codes, *[c for c, _ in self.more]])
        values = np.concatenate([self.values, *[v for _, v in self.more]])
        self.more, self.waiting = [], 0
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        first = np.flatnonzero(np.diff(codes, prepend=codes[:1] - 1))
        self.codes, self.values = codes[first], np.add.reduceat(values[order], first) if len(first) else values


class DenseSums:
    """Whole-number sums of few codes, a cell each; nothing waits, so memory does not follow the products."""

    def __init__(self, cells: int) -> None:
        self.held, self.known = np.zeros(cells, dtype=np.int64), np.zeros(cells, dtype=bool)

    def add(self, codes: np.ndarray, values: np.ndarray) -> None:
        np.add.at(self.held, codes, values)
        self.known[codes] = True

    def settle(self) -> None:
        self.codes = np.flatnonzero(self.known)
        self.values = self.held[self.codes]


def add_histories(
    sums: SparseSums | DenseSums, own: np.ndarray, place: np.ndarray, items: np.ndarray, at: np.ndarray, q: np.ndarray, width: int, at_once: int
) -> None:
    """Add, for each own entry (a position in ``items`` and the place of its row), its user's whole history.

    User r has ``items[at[r]:at[r + 1]]`` and weight ``q[r]``; codes are place * width + item.
    """
    user = np.searchsorted(at, own, side="right") - 1
    start, length = at[user], at[user + 1] - at[user]
    # Entries with very many products are cut into several.
    cuts = -(-length // at_once)
    entry = np.repeat(np.arange(len(own)), cuts)
    begun = (ranges(np.zeros(len(cuts), dtype=np.int64), cuts)) * at_once
    length = np.minimum(length[entry] - begun, at_once)
    start, place, weight = start[entry] + begun, place[entry], q[user[entry]]
    upto = np.cumsum(length)
    low = 0
    while low < len(length):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + at_once, side="right")))
        some = slice(low, high)
        codes = np.repeat(place[some] * width, length[some]) + items[ranges(start[some], length[some])]
        sums.add(codes, np.repeat(weight[some], length[some]))
        low = high


#: i, j and their strength and rank; of a hot item's share of users the sum and the partner's number of users instead.
FOUND = "i int, j int, strength double, rank int, s long, n int"


def _cut(codes: np.ndarray, values: np.ndarray, n: np.ndarray, width: int, k: int, strength: Callable) -> tuple[np.ndarray, ...]:
    """(place, j, strength, rank) of the k best of every row; ties by the lower j."""
    place, j = np.divmod(codes, width)
    held = strength(values, n[j])
    order = np.lexsort((j, -held, place))
    place, j, held = place[order], j[order], held[order]
    rank = np.arange(len(place)) - np.searchsorted(place, place) + 1
    kept = rank <= k
    return place[kept], j[kept], held[kept], rank[kept]


def _cut_batches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The batches in stretches of histories that hold about ``most`` items together; a history stays whole."""
    for batch in batches:
        upto = np.cumsum(batch.column("items").value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + most, side="right")))
            yield batch.slice(low, high - low)
            low = high


def _rows_of(batches: Iterator[pa.RecordBatch], blocks: int, width: int, k: int, strength: Callable, sizes: Sizes) -> Iterator[pa.RecordBatch]:
    """One block: all batches have one key."""
    cells = -(-width // blocks) * width
    sums = DenseSums(cells) if cells <= sizes.sums else SparseSums(2 * sizes.at_once)
    n, key, only = np.zeros(width, dtype=np.int32), 0, -1
    for batch in _cut_batches(batches, sizes.at_once):
        key, only = batch.column("key")[0].as_py(), batch.column("only")[0].as_py()
        packed = batch.column("items")
        items = packed.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        counts = batch.column("counts").flatten().to_numpy(zero_copy_only=False)
        lengths = packed.value_lengths().to_numpy(zero_copy_only=False)
        at = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        n[items] = np.abs(counts)
        own = np.flatnonzero(items == only if only >= 0 else (items % blocks == key) & (counts > 0))
        place = np.zeros(len(own), dtype=np.int64) if only >= 0 else items[own] // blocks
        add_histories(sums, own, place, items, at, batch.column("q").to_numpy(zero_copy_only=False), width, sizes.at_once)
    sums.settle()
    cuts = [0, *range(sizes.at_once, len(sums.codes), sizes.at_once), len(sums.codes)]
    # A row is never cut in two.
    row = sums.codes // width
    cuts = sorted({int(np.searchsorted(row, row[c], side="left")) if c < len(row) else c for c in cuts})
    for low, high in zip(cuts, cuts[1:]):
        codes, values = sums.codes[low:high], sums.values[low:high]
        if only >= 0:
            j = codes % width
            made = [np.full(len(j), only), j, np.full(len(j), np.nan), np.zeros(len(j)), values, n[j]]
        else:
            place, j, held, rank = _cut(codes, values, n, width, k, strength)
            made = [place * blocks + key, j, held, rank, np.zeros(len(j)), np.zeros(len(j))]
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int64(), pa.int32()]
        arrays = [pa.array(x.astype(t.to_pandas_dtype()), t) for x, t in zip(made, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["i", "j", "strength", "rank", "s", "n"])


def best_partners(
    rows: DataFrame, width: int, k: int, weight: Callable[[Column], Column], strength: Callable, sizes: Sizes = Sizes()
) -> DataFrame:
    """(i, j, strength, rank): the k strongest partners of every item, itself included; ties by the lower j.

    ``rows`` (user_id, idx int from 0 to ``width`` - 1, n: users of the item), distinct. ``weight`` makes a user's q from the
    number of items; ``strength(s, n_j)``, of numpy arrays or columns alike, orders the partners of one item.
    """
    spark = rows.sparkSession
    entry = F.struct(F.col("idx").cast("int").alias("idx"), F.col("n").cast("int").alias("n"))
    # A history holds an item once, so it is no longer than the catalogue.
    histories = materialize(rows.groupBy("user_id").agg(F.collect_list(entry).alias("h")))
    costs = materialize(
        histories.select(F.size("h").alias("n_u"), F.explode("h.idx").alias("idx")).groupBy("idx").agg(F.sum("n_u").alias("cost"))
    )
    needs = costs.agg(F.sum("cost"), F.sum(F.least("cost", F.lit(width))), F.sum((F.col("cost") > sizes.products).cast("int"))).first()
    products, sums, n_hot = (x or 0 for x in needs)
    blocks = max(math.ceil(products / sizes.products), math.ceil(sums / sizes.sums), spark.sparkContext.defaultParallelism)
    blocks = max(1, min(blocks, width))
    q = weight(F.size("h")).alias("q")
    keys = F.transform(F.array_distinct(F.transform(F.filter("h", lambda e: e["n"] > 0), lambda e: e["idx"] % blocks)), _key(-1))
    total = blocks
    if n_hot:
        # At most products / sizes.products hot items; their entries carry a negative n and the first of their tasks.
        shares = F.ceil(F.col("cost") / sizes.products).cast("int")
        hot = costs.where(F.col("cost") > sizes.products).withColumn("shares", shares)
        before = Window.orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
        hot = materialize(hot.withColumn("first", (blocks + F.coalesce(F.sum("shares").over(before), F.lit(0))).cast("int")).drop("cost"))
        total += hot.agg(F.sum("shares")).first()[0]
        marked = histories.select("user_id", F.explode("h").alias("e")).select("user_id", "e.*").join(hot, "idx", "left")
        n = F.when(F.col("shares").isNull(), F.col("n")).otherwise(-F.col("n"))
        histories = marked.groupBy("user_id").agg(F.collect_list(F.struct("idx", n.alias("n"), "first", "shares")).alias("h"))
        share = F.pmod(F.xxhash64("user_id"), F.lit(1 << 30)).cast("int")
        own = F.transform(
            F.filter("h", lambda e: e["n"] < 0),
            lambda e: F.struct((e["first"] + share % e["shares"]).alias("key"), e["idx"].alias("only")),
        )
        keys = F.concat(keys, own)
    sent = histories.select(q, "h", F.explode(keys).alias("t")).select("t.key", "t.only", "q", F.col("h.idx").alias("items"), F.col("h.n").alias("counts"))
    found = sent.repartitionById(total, "key").mapInArrow(lambda b: _rows_of(b, blocks, width, k, strength, sizes), FOUND)
    if not n_hot:
        return found.select("i", "j", "strength", "rank")
    found = materialize(found)
    added = found.where("rank = 0").groupBy("i", "j").agg(F.sum("s").alias("s"), F.max("n").alias("n"))
    added = added.select("i", "j", strength(F.col("s"), F.col("n")).alias("strength"))
    order = Window.partitionBy("i").orderBy(F.desc("strength"), "j")
    best = promising(added, k).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return found.where("rank > 0").select("i", "j", "strength", "rank").unionByName(best)


def _key(only: int) -> Callable[[Column], Column]:
    return lambda block: F.struct(block.cast("int").alias("key"), F.lit(only).cast("int").alias("only"))


# Step of a strength of 0, below that of every positive double.
NO_STEP = -100_000


def promising(pairs: DataFrame, k: int) -> DataFrame:
    """Drop the pairs that cannot be among the k strongest of ``i``, so only the rest is sorted.

    Strengths are counted per item in steps of an eighth of a power of two; the step that holds
    the k-th strongest is the bar, and every pair from that step on stays.
    """
    positive = F.floor(F.log2("strength") * 8)
    stepped = pairs.withColumn("_step", F.when(F.col("strength") > 0, positive).otherwise(NO_STEP).cast("int"))
    above = Window.partitionBy("i").orderBy(F.desc("_step")).rowsBetween(Window.unboundedPreceding, -1)
    bars = (
        stepped.groupBy("i", "_step")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_above", F.coalesce(F.sum("_n").over(above), F.lit(0)))
        .where(F.col("_above") < k)
        .groupBy("i")
        .agg(F.min("_step").alias("_bar"))
    )
    return stepped.join(bars, "i").where(F.col("_step") >= F.col("_bar")).drop("_step", "_bar")


__all__ = ["Sizes", "SparseSums", "add_histories", "best_partners", "promising", "ranges"]
