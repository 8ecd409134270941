"""Item neighbours too many for rows: packed by blocks of target items, and read as often as there are groups of users.

As rows, and shuffled to blocks, the K neighbours of a large catalogue take many times the log on disk. Here they are
stored once, as arrays in binary values: a value holds the neighbours that some source items have in one block of target items
(block idx % ``across``, place idx // ``across``), with whole-number sums in place of similarities, since few different ones
occur and they compress. Nothing else is sent but the histories, once to each block of source items they touch.

Lists are made by groups of users. A task holds the histories of its group and the best n so far of each user, and reads
one block of targets after another straight from the stored table, so neither similarities, histories nor unfinished lists
enter a shuffle. The n-th best score so far is the user's bar. Products are first added up in few cells that several targets
share; no similarity is negative, so a target whose cell stays below the bar is below it too and is dropped unsorted.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.operators.gram import DenseSums, Sizes, add_histories, ranges
from reelrank.session import materialize

# Places of items in a block of targets are 16 bits wide.
PLACES = 1 << 16
# Neighbours of a block of targets and log rows a task holds; places of all lists of a group of users.
HELD = 16_000_000
HELD_LOG = 40_000_000
LIST_PLACES = 4_000_000
# Products a task has at a time when it makes lists: what it adds them up in should stay in a processor's cache.
PRODUCTS = 1 << 17
# Users whose lists are cut at a time.
SOME_USERS = 1024
# Groups of users in one plan; more are done in rounds.
GROUPS = 24
_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20
SCORE_DIGITS = 9
UNIT = 10.0**SCORE_DIGITS

#: kind, block and number of entries of a packed value, and up to five arrays.
BLOB = pa.schema([("kind", pa.int32()), ("block", pa.int32()), ("m", pa.int32()), *[(c, pa.binary()) for c in "abcde"]])
_SQL = "kind int, block int, m int, " + ", ".join(f"{c} binary" for c in "abcde")
HISTORY, ITEMS, NEAR = 0, 1, 2


@dataclass(frozen=True)
class Packed:
    """The neighbours of all items of ``log``. ``items`` and ``near`` are stored values; ``histories`` (user_id, items) holds
    numbers of items, ascending; ``entries`` is the number of neighbours by block of targets."""

    log: DataFrame
    catalogue: DataFrame
    histories: DataFrame
    items: DataFrame
    near: DataFrame
    entries: tuple[int, ...]
    width: int
    length: Callable[[np.ndarray], np.ndarray]
    unit: float


def blob(kind: int, block: int, m: int, *arrays: np.ndarray) -> tuple:
    return (kind, block, m, *[x.tobytes() for x in arrays], *[None] * (5 - len(arrays)))


def _batch(blobs: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*blobs, strict=True), BLOB.types, strict=True)], schema=BLOB)


def _array(batch: pa.RecordBatch, column: str, row: int, kind: type) -> np.ndarray:
    return np.frombuffer(batch.column(column)[row].as_buffer(), dtype=kind)


def padded(row: np.ndarray, value: np.ndarray, rows: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(entries, their row less the first, their column, matrix) of some rows at a time; rows ascend, gaps are -inf."""
    counts = np.bincount(row, minlength=rows)
    ends = np.cumsum(counts)
    low = 0
    while low < rows:
        # As many rows as fit a matrix that is not much larger than what it holds.
        widest = np.maximum.accumulate(counts[low : low + 4096])
        cells = widest * np.arange(1, len(widest) + 1)
        fits = (cells <= 500_000) | (cells <= 2 * np.cumsum(counts[low : low + 4096]))
        high = low + max(1, int(np.argmin(fits)) if not fits.all() else len(fits))
        some = slice(ends[low] - counts[low], ends[high - 1])
        own = row[some] - low
        column = np.arange(some.stop - some.start) - np.repeat(ends[low:high] - counts[low:high] - some.start, counts[low:high])
        matrix = np.full((high - low, max(1, int(widest[high - low - 1]))), -np.inf)
        matrix[own, column] = value[some]
        yield some, own, column, matrix
        low = high


def at_least_nth(row: np.ndarray, value: np.ndarray, rows: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Which values reach the n-th greatest of their row, and that value by row, -inf where there are fewer; rows ascend."""
    kept, bars = np.ones(len(row), dtype=bool), []
    for some, own, _, matrix in padded(row, value, rows):
        wide = matrix.shape[1]
        bar = np.partition(matrix, wide - n, axis=1)[:, wide - n] if wide >= n else np.full(len(matrix), -np.inf)
        kept[some] = value[some] >= bar[own]
        bars.append(bar)
    return kept, np.concatenate([np.zeros(0), *bars])


def first_n(row: np.ndarray, value: np.ndarray, rows: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(entry, rank) of the n greatest values of every row, in this order; ties by the order given, rows ascend."""
    entries, ranks = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for some, own, _, matrix in padded(row, value, rows):
        order = np.argsort(-matrix, axis=1, kind="stable")[:, :n]
        counts = np.bincount(own, minlength=len(matrix))
        there = np.arange(order.shape[1]) < counts[:, None]
        first = some.start + np.cumsum(counts) - counts
        entries.append((first[:, None] + order)[there])
        ranks.append(np.broadcast_to(np.arange(1, order.shape[1] + 1), order.shape)[there])
    return np.concatenate(entries), np.concatenate(ranks)


def rounded(score: np.ndarray) -> np.ndarray:
    """Scores rounded as ``F.round`` does, halves up by their decimal digits."""
    scaled = score * UNIT
    whole = np.rint(scaled)
    for i in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-3):
        whole[i] = float(Decimal(repr(float(score[i]))).quantize(Decimal(1).scaleb(-SCORE_DIGITS), ROUND_HALF_UP).scaleb(SCORE_DIGITS))
    return np.where(np.abs(scaled) < 2.0**53, whole / UNIT, score)


class _Histories:
    """Histories as they come, laid end to end."""

    def __init__(self, expected: int) -> None:
        # Memory is taken as it fills.
        self.items, self.filled = np.empty(expected, dtype=np.int32), 0
        self.lengths: list[np.ndarray] = []

    def add(self, items: np.ndarray, lengths: np.ndarray) -> None:
        end = self.filled + len(items)
        if end > len(self.items):
            self.items = np.concatenate([self.items[: self.filled], np.empty(max(end, self.filled // 4), dtype=np.int32)])
        self.items[self.filled : end], self.filled = items, end
        self.lengths.append(lengths.astype(np.int64))

    def at(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, dtype=np.int64), *self.lengths]))])


def _sums(items: np.ndarray, at: np.ndarray, own: np.ndarray, user: np.ndarray, place: np.ndarray, q: np.ndarray, kinds: np.ndarray, width: int, at_once: int) -> tuple[np.ndarray, np.ndarray]:
    """(code, sum), ascending, code place * width + item; ``q`` are positions in ``kinds``, the different weights."""
    start, length = at[user], at[user + 1] - at[user]
    if length.sum() > at_once and place[-1] == 0:
        sums = DenseSums(width)
        add_histories(sums, own, place, items, at, kinds[q], width, at_once)
        sums.settle()
        return sums.codes, sums.values
    codes = np.repeat(place * width, length) + items[ranges(start, length)]
    bits = max(1, len(kinds) - 1).bit_length()
    if int(place[-1] + 1) * width < 1 << (63 - bits):
        # Code and weight in one number, which sorts several times as fast as positions do.
        codes = np.sort(codes << bits | np.repeat(q[user], length))
        values = kinds[codes & (1 << bits) - 1]
        codes >>= bits
    else:
        order = np.argsort(codes, kind="stable")
        codes, values = codes[order], np.repeat(kinds[q[user]], length)[order]
    first = np.flatnonzero(np.diff(codes, prepend=codes[:1] - 1))
    return codes[first], np.add.reduceat(values, first)


def _near_of(batches: Iterator[pa.RecordBatch], blocks: int, across: int, width: int, k: int, length: Callable, unit: float, sizes: Sizes, expected: int) -> Iterator[pa.RecordBatch]:
    """Packed neighbours of one block of source items; all batches have one key."""
    held, weights, key = _Histories(expected), [np.zeros(0, dtype=np.int64)], 0
    n = np.zeros(width, dtype=np.int32)
    for batch in batches:
        key = batch.column("key")[0].as_py()
        counted = batch.column("counts").is_valid().to_numpy(zero_copy_only=False)
        for some, table in ((batch.filter(pa.array(counted)), True), (batch.filter(pa.array(~counted)), False)):
            items = some.column("items").flatten().to_numpy(zero_copy_only=False)
            if table:
                n[items] = some.column("counts").flatten().to_numpy(zero_copy_only=False)
            else:
                held.add(items, some.column("items").value_lengths().to_numpy(zero_copy_only=False))
                weights.append(some.column("q").to_numpy(zero_copy_only=False))
    at, items, a = held.at(), held.items, length(n)
    lengths = np.diff(at)
    kinds, q = np.unique(np.concatenate(weights), return_inverse=True)
    step = max(1, sizes.at_once // 2)
    # Positions in 32 bits where they fit: there are as many as a block has log rows.
    narrow = np.int32 if held.filled < 1 << 31 else np.int64
    cuts = range(0, held.filled, step)
    own = np.concatenate([np.zeros(0, narrow), *[(np.flatnonzero(items[c : min(c + step, held.filled)] % blocks == key) + c).astype(narrow) for c in cuts]])
    own = own[np.argsort(items[own], kind="stable")]
    user = np.concatenate([np.zeros(0, np.int32), *[(np.searchsorted(at, own[c : c + step], side="right") - 1).astype(np.int32) for c in range(0, len(own), step)]])
    first = np.flatnonzero(np.diff(items[own], prepend=np.int32(-1)))
    # Products up to each item.
    work = np.concatenate([[0], np.cumsum(np.add.reduceat(lengths[user], first) if len(first) else first)])
    low = 0
    while low < len(first):
        high = max(low + 1, int(np.searchsorted(work, work[low] + step, side="right")) - 1)
        some = slice(first[low], first[high] if high < len(first) else len(own))
        mine = user[some].astype(np.int64)
        source = items[own[first[low:high]]]
        place = np.searchsorted(source, items[own[some]])
        codes, values = _sums(items, at, own[some], mine, place, q, kinds, width, step)
        row, j = np.divmod(codes, width)
        held_by = a[j] * (values / unit)
        kept, _ = at_least_nth(row, held_by, len(source), k)
        row, j, values, held_by = row[kept], j[kept], values[kept], held_by[kept]
        entry, rank = first_n(row, held_by, len(source), k)
        row, j, values = row[entry], j[entry], values[entry]
        block, local = j % across, j // across
        order = np.argsort(block.astype(np.uint16), kind="stable")
        ends = np.searchsorted(block[order], np.arange(across + 1))
        blobs = []
        for t in range(across):
            mine = order[ends[t] : ends[t + 1]]
            if len(mine):
                rows, count = np.unique(row[mine], return_counts=True)
                blobs.append(blob(NEAR, t, len(mine), source[rows].astype(np.int32), count.astype(np.int32), local[mine].astype(np.uint16), values[mine], rank[mine].astype(np.int32)))
        yield _batch(blobs)
        low = high


def _as_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, user_id, items, allowed): one packed value a batch and block."""
    for batch in batches:
        block = batch.column("block").to_numpy(zero_copy_only=False)
        for t in np.unique(block):
            some = batch.filter(pa.array(block == t))
            users, lists = some.column("user_id"), some.column("items")
            known = users.is_valid().to_numpy(zero_copy_only=False)
            arrays = [users.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), known.astype(np.uint8)]
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
            allowed = some.column("allowed").to_numpy(zero_copy_only=False).astype(np.int32)
            yield _batch([blob(HISTORY, int(t), some.num_rows, *arrays, lengths, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32), allowed)])


def _items_blobs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        arrays = [batch.column(c).fill_null(0).to_numpy(zero_copy_only=False).astype(t) for c, t in (("idx", np.int32), ("item_id", np.int64), ("n", np.int32))]
        if batch.num_rows:
            yield _batch([blob(ITEMS, 0, batch.num_rows, *arrays)])


def pack_similarity(
    log: DataFrame, catalogue: DataFrame, rows: DataFrame, width: int, k: int, weight: Callable[[Column], Column],
    length: Callable, unit: float, sizes: Sizes = Sizes(), held: int = HELD, held_log: int = HELD_LOG,
) -> Packed | None:
    """The k strongest partners of every item, as ``gram.best_partners`` has them; None where one item has more products than
    a task can hold the histories of.

    ``catalogue`` (item_id, idx, n) stored; ``rows`` (user_id, idx), distinct. A sum is so many ``unit``; the strength of a
    partner with n users is ``length(n)`` times it.
    """
    cores = log.sparkSession.sparkContext.defaultParallelism
    histories = materialize(rows.groupBy("user_id").agg(F.sort_array(F.collect_list("idx")).alias("items")))
    n_u = F.size("items").cast("double")
    tries = [1 << e for e in range(21)]
    sent = [F.sum(n_u * (1 - F.pow(F.lit(1 - 1 / b), n_u))) for b in tries]
    products, longest, *sent = histories.agg(F.sum(n_u * n_u), F.max(n_u), *sent).first()
    most = min(sizes.products, held_log)
    if catalogue.agg(F.max("n")).first()[0] * longest > most:
        costs = histories.select(F.size("items").alias("n_u"), F.explode("items").alias("idx")).groupBy("idx").agg(F.sum("n_u").alias("cost"))
        if costs.agg(F.max("cost")).first()[0] > most:
            return None
    # As many copies of the log as there are blocks, and no more blocks than the work and what a task may hold ask for.
    needed = next((b for b, rows_sent in zip(tries, sent, strict=True) if rows_sent / b <= held_log), tries[-1])
    blocks = min(max(cores, math.ceil(products / sizes.products), needed), width)
    expected = int(min(sent[0], 1.1 * next((s for b, s in zip(tries, sent, strict=True) if b >= blocks), products) / blocks)) + 1000
    across = max(1, math.ceil(width * k / held), math.ceil(width / PLACES))
    keys = F.array_distinct(F.transform("items", lambda x: (x % blocks).cast("int")))
    own = histories.select(F.explode(keys).alias("key"), weight(F.size("items")).alias("q"), "items", F.lit(None).cast("array<int>").alias("counts"))
    counted = catalogue.groupBy(F.floor(F.col("idx") / PLACES).alias("_some")).agg(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), F.col("n").cast("int").alias("n"))).alias("e"))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("key")
    counted = counted.select(everywhere, F.lit(0).cast("long").alias("q"), F.col("e.idx").alias("items"), F.col("e.n").alias("counts"))
    found = counted.unionByName(own).repartitionById(blocks, "key")
    found = found.mapInArrow(lambda b: _near_of(b, blocks, across, width, k, length, unit, sizes, expected), _SQL)
    near = materialize(found, by="block")
    entries = {r["block"]: r["m"] for r in near.groupBy("block").agg(F.sum("m").alias("m")).collect()}
    items = materialize(catalogue.select("idx", "item_id", "n").mapInArrow(_items_blobs, _SQL))
    return Packed(log, catalogue, histories, items, near, tuple(entries.get(t, 0) for t in range(across)), width, length, float(unit))


def _columns(df: DataFrame) -> DataFrame:
    return df.select(*BLOB.names)


def _one_task(parts: list[DataFrame]) -> DataFrame:
    """The parts one after another in a single task that reads them where they are stored."""
    return _union([_columns(p) for p in parts]).coalesce(1)


def _tasks(tasks: list[DataFrame], table: DataFrame) -> DataFrame:
    """The tasks side by side. A union of single partitions alone would be made one partition; a scan of nothing keeps them apart."""
    return _union([*tasks, _columns(table.where(F.col("block") == -1))])


def _union(frames: list[DataFrame]) -> DataFrame:
    while len(frames) > 1:
        frames = [frames[i].unionByName(frames[i + 1]) if i + 1 < len(frames) else frames[i] for i in range(0, len(frames), 2)]
    return frames[0]


def _small_batches(df: DataFrame) -> None:
    """Bound what is handed to Python at a time, also in the session's later steps: packed values are large."""
    spark = df.sparkSession
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH, "1g")) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


class _Catalogue:
    """Ids and length normalisation of all items, by number."""

    def __init__(self, width: int, length: Callable) -> None:
        self.ids, self.a, self.of = np.zeros(width, dtype=np.int64), np.zeros(width), length

    def add(self, batch: pa.RecordBatch, r: int) -> None:
        idx = _array(batch, "a", r, np.int32)
        self.ids[idx], self.a[idx] = _array(batch, "b", r, np.int64), self.of(_array(batch, "c", r, np.int32))


def similarity_rows(packed: Packed) -> DataFrame:
    """(item_i, item_j, similarity, rank), one row per neighbour."""
    width, across, length, unit = packed.width, len(packed.entries), packed.length, packed.unit

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _Catalogue(width, length)
        for batch in batches:
            for r, (kind, block) in enumerate(zip(batch.column("kind").to_pylist(), batch.column("block").to_pylist(), strict=True)):
                if kind == ITEMS:
                    items.add(batch, r)
                    continue
                i = np.repeat(_array(batch, "a", r, np.int32), _array(batch, "b", r, np.int32))
                j = _array(batch, "c", r, np.uint16).astype(np.int64) * across + block
                similarity = items.a[i] * (items.a[j] * (_array(batch, "d", r, np.int64) / unit))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (items.ids[i], items.ids[j], similarity, _array(batch, "e", r, np.int32))], names=["item_i", "item_j", "similarity", "rank"])

    _small_batches(packed.near)
    blocks = [_one_task([packed.items, packed.near.where(F.col("block") == t)]) for t in range(across)]
    return _tasks(blocks, packed.near).mapInArrow(rows, "item_i bigint, item_j bigint, similarity double, rank int")


class _Lists:
    """Best n so far of a group of users: (user, item, score), users ascending, and the score a new item must reach."""

    def __init__(self, users: int, n: int) -> None:
        self.users, self.n = users, n
        self.held = [(np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32), np.zeros(0))]
        self.bar, self.waiting = np.full(users, -np.inf), 0

    def add(self, user: np.ndarray, item: np.ndarray, score: np.ndarray) -> None:
        self.held.append((user.astype(np.int32), item.astype(np.int32), score))
        self.waiting += len(user)

    def cut(self) -> None:
        """Down to the best n, ties with the last by the lower item; some users at a time."""
        cuts = [np.searchsorted(part[0], np.arange(0, self.users + SOME_USERS, SOME_USERS)) for part in self.held]
        done: list[tuple[np.ndarray, ...]] = []
        for k, low in enumerate(range(0, self.users, SOME_USERS)):
            parts = [[column[at[k] : at[k + 1]] for column in part] for part, at in zip(self.held, cuts, strict=True)]
            user, item, score = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.argsort(user, kind="stable")
            user, item, score = user[order], item[order], score[order]
            by, high = rounded(score), min(low + SOME_USERS, self.users)
            kept, bar = at_least_nth(user - low, by, high - low, self.n)
            user, item, score, by = user[kept], item[kept], score[kept], by[kept]
            if len(user) > 1.2 * (high - low) * self.n:
                entry, _ = self._ordered(user, item, by)
                user, item, score = user[entry], item[entry], score[entry]
            done.append((user, item, score))
            self.bar[low:high] = np.maximum(self.bar[low:high], bar)
        self.held = [tuple(np.concatenate(c) for c in zip(*done, strict=True))] if done else self.held[:1]
        self.waiting = 0

    def _ordered(self, user: np.ndarray, item: np.ndarray, by: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(user.astype(np.int64) << 32 | item)
        low = user[0] if len(user) else 0
        entry, rank = first_n(user[order] - low, by[order], int(user[-1] - low) + 1 if len(user) else 0, self.n)
        return order[entry], rank

    def results(self) -> Iterator[tuple[np.ndarray, ...]]:
        """(user, item, score, rank), in order, of some users at a time."""
        self.cut()
        for low in range(0, self.users, SOME_USERS):
            some = slice(*np.searchsorted(self.held[0][0], [low, low + SOME_USERS]))
            user, item, score = (c[some] for c in self.held[0])
            entry, rank = self._ordered(user, item, rounded(score))
            yield user[entry], item[entry], score[entry], rank


class _Block:
    """Neighbours in one block of targets, by source item."""

    def __init__(self, width: int, entries: int) -> None:
        self.start, self.size = np.zeros(width, dtype=np.int32), np.zeros(width, dtype=np.int32)
        self.place, self.value, self.filled = np.empty(entries, dtype=np.uint16), np.empty(entries), 0

    def add(self, source: np.ndarray, count: np.ndarray, place: np.ndarray, value: np.ndarray) -> None:
        end = self.filled + len(place)
        self.start[source], self.size[source] = self.filled + np.cumsum(count) - count, count
        self.place[self.filled : end], self.value[self.filled : end], self.filled = place, value, end

    def offer(self, lists: _Lists, at: np.ndarray, items: np.ndarray, block: int, across: int, products: int) -> None:
        """Add to the lists what reaches them."""
        per_user = np.concatenate([[0], np.cumsum(self.size[items], dtype=np.int64)])[at]
        low = 0
        while low < lists.users:
            high = max(low + 1, int(np.searchsorted(per_user, per_user[low] + products, side="right")) - 1)
            if per_user[high] > per_user[low]:
                self._offer(lists, low, high, at, items, per_user, block, across)
            low = high

    def _offer(self, lists: _Lists, low: int, high: int, at: np.ndarray, items: np.ndarray, per_user: np.ndarray, block: int, across: int) -> None:
        own = items[at[low] : at[high]]
        entry = ranges(self.start[own].astype(np.int64), self.size[own].astype(np.int64))
        row = np.repeat(np.arange(high - low), np.diff(per_user[low : high + 1]))
        place, value = self.place[entry], self.value[entry]
        bar = lists.bar[low:high]
        # What rounding may add to a sum or take from it.
        reach = bar - np.abs(bar) * 1e-9 - 2 / UNIT
        if np.isfinite(bar).any():
            cells = 1 << min(16, max(8, math.ceil(math.log2(2 * len(row) / (high - low) + 1))))
            cell = row * cells
            cell += place & np.uint16(cells - 1)
            added = np.bincount(cell, weights=value, minlength=(high - low) * cells).reshape(-1, cells)
            kept = np.flatnonzero((added >= reach[:, None]).ravel()[cell])
            row, place, value = row[kept], place[kept], value[kept]
        # Added up in the order of the history.
        code, at_code = np.unique(row * PLACES + place.astype(np.int64), return_inverse=True)
        score = np.bincount(at_code, weights=value, minlength=len(code))
        row, item = code // PLACES, code % PLACES * across + block
        kept = score >= reach[row]
        # Histories ascend, and so do the keys of what is seen.
        wide = np.int64(PLACES) * across
        seen = np.repeat(np.arange(high - low), np.diff(at[low : high + 1])) * wide + own
        key = row * wide + item
        kept &= seen[np.minimum(np.searchsorted(seen, key), len(seen) - 1)] != key
        row, item, score = row[kept], item[kept], score[kept]
        if len(row) > (high - low) * lists.n:
            kept, found = at_least_nth(row, rounded(score), high - low, lists.n)
            row, item, score = row[kept], item[kept], score[kept]
            lists.bar[low:high] = np.maximum(bar, found)
        lists.add(row + low, item, score)


LIST_ROWS = "user_id bigint, item_id bigint, score double, rank int"


def _lists_of(batches: Iterator[pa.RecordBatch], packed: tuple, n: int, expected: int, products: int) -> Iterator[pa.RecordBatch]:
    """Lists of one group of users: histories, then the catalogue, then block by block."""
    entries, width, length, unit = packed
    across = len(entries)
    items, held = _Catalogue(width, length), _Histories(expected)
    users: list[tuple[np.ndarray, ...]] = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.int32))]
    lists = near = at = of_block = None
    now, done = -1, set()

    def finish() -> None:
        if near.filled != entries[now] or now in done:
            raise RuntimeError(f"block {now} did not arrive in one piece")
        done.add(now)
        near.offer(lists, at, held.items, now, across, products)
        if 2 * lists.waiting > lists.users * n:
            lists.cut()

    for batch in batches:
        for r, (kind, block) in enumerate(zip(batch.column("kind").to_pylist(), batch.column("block").to_pylist(), strict=True)):
            if kind == HISTORY:
                if lists is not None:
                    raise RuntimeError("histories came late")
                users.append(tuple(_array(batch, c, r, t).copy() for c, t in (("a", np.int64), ("b", np.uint8), ("e", np.int32))))
                held.add(_array(batch, "d", r, np.int32), _array(batch, "c", r, np.int32))
            elif kind == ITEMS:
                items.add(batch, r)
            else:
                if lists is None:
                    at = held.at()
                    held.items = held.items[: held.filled]
                    lists = _Lists(len(at) - 1, n)
                if block != now:
                    if near is not None:
                        finish()
                    near, now = None, block
                    near, of_block = _Block(width, entries[block]), items.a[block::across].copy()
                source, count, place = _array(batch, "a", r, np.int32), _array(batch, "b", r, np.int32), _array(batch, "c", r, np.uint16)
                similarity = np.repeat(items.a[source], count) * (of_block[place] * (_array(batch, "d", r, np.int64) / unit))
                near.add(source, count, place, similarity)
    if near is None:
        return
    finish()
    near = None
    if len(done) != sum(m > 0 for m in entries):
        raise RuntimeError("blocks are missing")
    ids, known, allowed = (np.concatenate(c) for c in zip(*users, strict=True))
    for user, item, score, rank in lists.results():
        some = rank <= allowed[user]
        user = user[some]
        columns = [pa.array(ids[user], mask=known[user] == 0), pa.array(items.ids[item[some]]), pa.array(score[some]), pa.array(rank[some].astype(np.int32))]
        yield pa.RecordBatch.from_arrays(columns, names=["user_id", "item_id", "score", "rank"])


def ranked_lists(
    log: DataFrame, packed: Packed, n: int, allowed: DataFrame | None = None, list_places: int = LIST_PLACES, held_log: int = HELD_LOG // 4,
    products: int = PRODUCTS, groups: int = GROUPS,
) -> DataFrame:
    """(user_id, item_id, score, rank): the n best unseen items of every user, the first ``allowed`` of them (user_id, allowed:
    users not there have no list)."""
    cores = log.sparkSession.sparkContext.defaultParallelism
    if log is packed.log:
        histories = packed.histories
    else:
        rows = log.select("user_id", "item_id").join(packed.catalogue.select("item_id", "idx"), "item_id")
        histories = rows.groupBy("user_id").agg(F.sort_array(F.collect_list("idx")).alias("items"))
    users, rows = histories.agg(F.count(F.lit(1)), F.sum(F.size("items"))).first()
    down = max(cores, math.ceil((users or 0) * n / list_places), math.ceil((rows or 0) / held_log))
    down = math.ceil(down / cores) * cores
    if allowed is None:
        histories = histories.withColumn("allowed", F.lit(n))
    else:
        histories = histories.join(allowed, "user_id")
    block = F.pmod(F.xxhash64("user_id"), F.lit(down)).cast("int").alias("block")
    dealt = histories.select(block, "user_id", "items", "allowed").repartitionById(down, "block")
    dealt = materialize(dealt.mapInArrow(_as_blobs, _SQL), by="block")
    expected = int(1.2 * (rows or 0) / down) + 1000
    known = (packed.entries, packed.width, packed.length, packed.unit)
    unread = packed.near.withColumn("e", F.lit(None).cast("binary"))
    near = [unread.where(F.col("block") == t) for t, m in enumerate(packed.entries) if m]
    _small_batches(log)

    def lists(some: range) -> DataFrame:
        tasks = [_one_task([dealt.where(F.col("block") == g), packed.items, *near]) for g in some]
        return _tasks(tasks, dealt).mapInArrow(lambda b: _lists_of(b, known, n, expected, products), LIST_ROWS)

    if down <= groups:
        return lists(range(down))
    return _union([materialize(lists(range(g, min(g + groups, down)))) for g in range(0, down, groups)])
