"""BM25 item neighbours (Robertson & Zaragoza 2009; item as document, user as term).

n_i  users of item i, n_u  items of user u, N  items with a watch, avg  mean n_i
a_i  = (K1 + 1) / (K1 * (1 - B + B * n_i / avg) + 1)
b_u  = ln N - ln(1 + n_u)
w(i, u) = a_i * b_u,   sim(i, j) = sum over common users of w(i, u) * w(j, u) = a_i * a_j * S(i, j)

S(i, j) is the sum of b_u^2 over the common users. It is kept in whole units of 1e-8, so the sum
does not depend on the order in which rows arrive: a task that is run again gives the same bits,
and the neighbours of an item do not flip between ties.

Sums and neighbours come from ``gram``: blocks of items to which histories are sent, never pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.operators import gram, packed
from reelrank.operators.gram import ranges
from reelrank.operators.skew import HOT_ROWS, HotKeys, hot_keys, number_all, skew_join
from reelrank.session import as_view, materialize

# Neighbours kept, term saturation, length normalisation.
NEIGHBOURS = 210
K1 = 1.1
B = 0.4

UNIT = 100_000_000
# Blocks of the history x similarity product: similarities a task holds and products it makes, bytes of a log row, a
# similarity and a row of a list as they are sent; score cells and products held at a time.
HELD = 16_000_000
TASK_PRODUCTS = 10_000_000_000
ROW_BYTES = 8
SIM_BYTES = 16
LIST_BYTES = 24
SCORE_CELLS = 4_000_000
PRODUCTS = 2_000_000
SCORE_DIGITS = 9
# Rows of lists from which a first pass over the product, which finds how good a row must be, costs less than they do.
BAR_ROWS = 20_000_000
# Neighbours from which they are packed in place of kept as rows.
PACKED_ROWS = 20_000_000


def _item_side(log: DataFrame, k1: float, b: float) -> DataFrame:
    """(item_id, a): length normalisation of every item."""
    items = log.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_i"))
    mean = items.agg(F.avg("n_i")).scalar()
    return items.select("item_id", ((k1 + 1) / (k1 * (1 - b + b * F.col("n_i") / mean) + 1)).alias("a"))


def _user_side(log: DataFrame) -> DataFrame:
    """(user_id, n_u, b): inverse frequency weight of every user."""
    n_items = log.select("item_id").distinct().agg(F.count(F.lit(1))).scalar()
    users = log.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_u"))
    return users.withColumn("b", F.log(n_items.cast("double")) - F.log(1.0 + F.col("n_u")))


def _units(b: Column) -> Column:
    return F.round(b * b * UNIT).cast("bigint")


def item_weights(log: DataFrame, k1: float = K1, b: float = B) -> DataFrame:
    """w(i, u) for every row of the deduplicated log."""
    users = skew_join(log.select("user_id", "item_id"), _user_side(log), ["user_id"], "inner", hot_keys(log, ["user_id"]), ["item_id"])
    both = skew_join(users, _item_side(log, k1, b), ["item_id"], "inner", hot_keys(log, ["item_id"]), ["user_id"])
    return both.select("user_id", "item_id", (F.col("a") * F.col("b")).alias("weight"))


def item_similarity(
    log: DataFrame, k: int = NEIGHBOURS, k1: float = K1, b: float = B, sizes: gram.Sizes = gram.Sizes(), packed_rows: int = PACKED_ROWS, **options
) -> DataFrame:
    """The k most similar items of every item, itself included: (item_i, item_j, similarity, rank).

    Above ``packed_rows`` rows it is a view of packed arrays, from which lists are made without the rows (``packed``, which
    has the ``options``).
    """
    # Stored: numbering many items reads them several times.
    counted = materialize(log.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")))
    # Numbers in the order of the ids, so ties fall the same way.
    items = materialize(number_all(counted, "item_id", "idx").withColumn("idx", (F.col("idx") - 1).cast("int")))
    n_items, mean, most = items.agg(F.count(F.lit(1)), F.avg("n"), F.max("n")).first()
    if not n_items:
        return log.sparkSession.createDataFrame([], "item_i bigint, item_j bigint, similarity double, rank int")
    hot = hot_keys(log, ["item_id"]) if most > HOT_ROWS else HotKeys(("item_id",), None, HOT_ROWS)
    rows = skew_join(log.select("user_id", "item_id"), items, ["item_id"], "inner", hot, ["user_id"])

    def length(n):
        """Length normalisation of an item with n users."""
        return (k1 + 1) / (k1 * (1 - b + b * n / mean) + 1)

    def strength(s, n):
        return length(n) * (s / float(UNIT))

    def weight(n_u: Column) -> Column:
        return _units(F.log(F.lit(float(n_items))) - F.log(1.0 + n_u))

    if n_items * k > packed_rows:
        held = packed.pack_similarity(log, items, rows.select("user_id", "idx"), n_items, k, weight, length, UNIT, sizes, **options)
        if held is not None:
            return as_view(packed.similarity_rows(held), held)
    best = gram.best_partners(rows.select("user_id", "idx", "n"), n_items, k, weight, strength, sizes)
    first = items.select(F.col("idx").alias("i"), F.col("item_id").alias("item_i"), length(F.col("n")).alias("a"))
    second = items.select(F.col("idx").alias("j"), F.col("item_id").alias("item_j"))
    return best.join(first, "i").join(second, "j").select("item_i", "item_j", (F.col("a") * F.col("strength")).alias("similarity"), "rank")


class _Near:
    """Similarities of one block of target items, by source item."""

    def __init__(self, source: np.ndarray, target: np.ndarray, value: np.ndarray) -> None:
        order = np.lexsort((target, source))
        self.sources, at = np.unique(source[order], return_index=True)
        self.at = np.append(at, len(source))
        self.targets, self.column = np.unique(target[order], return_inverse=True)
        self.value = value[order]

    def _scores(self, users: np.ndarray, first: np.ndarray, item: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first user, scores, rounded scores or -inf where an item is seen or unknown) of some users at a time."""
        width = len(self.targets)
        step = max(1, SCORE_CELLS // max(1, width))
        for low in range(0, len(users) if width else 0, step):
            height = len(users[low : low + step])
            some = slice(first[low], first[low + height])
            rows = np.repeat(np.arange(height), np.diff(first[low : low + height + 1]))
            source = np.minimum(np.searchsorted(self.sources, item[some]), len(self.sources) - 1)
            length = np.where(self.sources[source] == item[some], self.at[source + 1] - self.at[source], 0)
            score = np.zeros(height * width)
            known = np.zeros(height * width, dtype=bool)
            # Added up slice by slice, also inside one user, so memory does not follow the histories.
            upto = np.cumsum(length)
            cuts = np.searchsorted(upto, np.arange(0, upto[-1] if len(upto) else 0, PRODUCTS), side="left")
            for begin, end in zip(cuts, [*cuts[1:], len(length)]):
                part = slice(begin, end)
                entry = ranges(self.at[source[part]], length[part])
                cell = np.repeat(rows[part] * width, length[part]) + self.column[entry]
                np.add.at(score, cell, self.value[entry])
                known[cell] = True
            target = np.minimum(np.searchsorted(self.targets, item[some]), width - 1)
            own = self.targets[target] == item[some]
            known[(rows * width + target)[own]] = False
            score = score.reshape(height, width)
            yield low, score, np.where(known.reshape(height, width), np.round(score, SCORE_DIGITS), -np.inf)

    def nth(self, users: np.ndarray, first: np.ndarray, item: np.ndarray, n: int) -> np.ndarray:
        """Rounded score of every user's n-th best unseen item of this block, -inf where there are fewer."""
        found, width = np.full(len(users), -np.inf), len(self.targets)
        for low, _, rank_by in self._scores(users, first, item) if width >= n else ():
            found[low : low + len(rank_by)] = np.partition(rank_by, width - n, axis=1)[:, width - n]
        return found

    def lists(self, users: np.ndarray, first: np.ndarray, item: np.ndarray, n: int, bar: np.ndarray | None = None) -> pd.DataFrame:
        """Best n unseen items of this block for every user; user u has ``item[first[u]:first[u + 1]]``, ascending.

        Items below the user's ``bar`` may be left out."""
        found = []
        width = len(self.targets)
        for low, score, rank_by in self._scores(users, first, item):
            height = len(score)
            least = np.partition(rank_by, width - n, axis=1)[:, width - n] if width > n else np.full(height, -np.inf)
            if bar is not None:
                least = np.maximum(least, bar[low : low + height] - 2 * 10**-SCORE_DIGITS)
            row, col = np.nonzero((rank_by >= least[:, None]) & np.isfinite(rank_by))
            best = np.lexsort((col, -rank_by[row, col], row))
            row, col = row[best], col[best]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            # A score halfway between two digits may be rounded the other way by the window that orders the lists.
            scaled = score * 10**SCORE_DIGITS
            halfway = np.abs(scaled - np.floor(scaled) - 0.5) < 1e-3
            unsure = halfway & np.isfinite(rank_by) & (rank_by >= least[:, None] - 1.5 * 10**-SCORE_DIGITS)
            unsure[row[place < n], col[place < n]] = False
            more = np.nonzero(unsure)
            row, col = np.concatenate([row[place < n], more[0]]), np.concatenate([col[place < n], more[1]])
            found.append(pd.DataFrame({"user_id": users[low + row], "item_id": self.targets[col], "score": score[row, col]}))
        if not found:
            return pd.DataFrame({"user_id": np.zeros(0, "int64"), "item_id": np.zeros(0, "int64"), "score": np.zeros(0)})
        return pd.concat(found)


def _block_lists(history: pd.DataFrame, near: pd.DataFrame, n: int) -> pd.DataFrame:
    """Best n unseen items of this block for every user of ``history``."""
    history = history.sort_values(["user_id", "item_id"], kind="stable")
    users, first = np.unique(history["user_id"].to_numpy(), return_index=True)
    held = _Near(*(near[c].to_numpy() for c in ("item_i", "item_j", "similarity")))
    return held.lists(users, np.append(first, len(history)), history["item_id"].to_numpy(), n)


def _flat(packed: pa.ListArray, kind: type) -> np.ndarray:
    return packed.flatten().to_numpy(zero_copy_only=False).astype(kind)


def _lists_of(batches: Iterator[pa.RecordBatch], n: int, bars: bool = False) -> Iterator[pa.RecordBatch]:
    """Lists of one block: first the similarities, which are held, then histories, batch by batch. A history has its user's bar
    as the only weight; with ``bars`` the score of its n-th best item is handed on instead of the list."""
    parts: list[tuple[np.ndarray, ...]] = []
    held = None
    for batch in batches:
        ids, items = batch.column("id").to_numpy(zero_copy_only=False), batch.column("items")
        sizes = items.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        near = int((batch.column("kind").to_numpy(zero_copy_only=False) == 0).sum())
        if near:
            packed = batch.slice(0, near)
            parts.append((np.repeat(ids[:near], sizes[:near]), _flat(packed.column("items"), np.int64), _flat(packed.column("weights"), np.float64)))
        if near == len(ids):
            continue
        if held is None:
            none = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
            held = _Near(*(np.concatenate(c) for c in zip(none, *parts)))
            parts.clear()
        first = np.concatenate([[0], np.cumsum(sizes[near:])])
        history = _flat(items.slice(near), np.int64)
        if bars:
            reached = pd.DataFrame({"user_id": ids[near:], "bar": held.nth(ids[near:], first, history, n)})
            yield pa.RecordBatch.from_pandas(reached, schema=_BARS, preserve_index=False)
            continue
        found = held.lists(ids[near:], first, history, n, _flat(batch.column("weights").slice(near), np.float64))
        yield pa.RecordBatch.from_pandas(found, schema=_LISTS, preserve_index=False)


_BARS = pa.schema([("user_id", pa.int64()), ("bar", pa.float64())])
_LISTS = pa.schema([("user_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64())])


def grid(
    log_rows: int, users: int, n: int, similarities: int, items: int, cores: int, held: int = HELD, products: int = TASK_PRODUCTS
) -> tuple[int, int]:
    """(user blocks, item blocks) that send least.

    A log row goes to every item block, and every item block sends on n items per user; a similarity goes to every user
    block. There are as many tasks as keep ``products`` each. For a given number of tasks the bytes are least where both
    sides send as much; a task holds ``held`` similarities at most.
    """
    tasks = max(cores, math.ceil(log_rows * (similarities / max(1, items)) / products))
    per_item_block = log_rows * ROW_BYTES + users * n * LIST_BYTES
    balanced = math.sqrt(tasks * similarities * SIM_BYTES / max(1, per_item_block))
    across = max(1, math.ceil(similarities / held), min(round(balanced), tasks, items))
    return max(1, math.ceil(tasks / across)), across


def neighbour_lists(
    log: DataFrame, sim: DataFrame, n: int, held: int = HELD, products: int = TASK_PRODUCTS, bar_rows: int = BAR_ROWS
) -> DataFrame:
    """Unseen items with the highest summed similarity to the history: (user_id, item_id, score).

    The n best of every user are among the rows; ``sim`` should be a stored table.

    history x similarity is a matrix product with K terms per log row. Sending those terms through a
    shuffle costs some hundred times the log, so the product is cut into blocks instead, see ``grid``. Histories are sent
    as one array per user and item block, similarities as one array per source item and block. A task holds its
    similarities and reads histories as they come; products are added in slices of bounded size, also inside one user.
    A history holds an item once, so it is no longer than the catalogue.

    Every item block hands on n rows per user. Where that makes more than ``bar_rows``, a first pass hands on one number per user
    and block: the score of the m-th best item, m blocks being n items at least. No item of the list is below the least
    of these, and the second pass hands on what reaches it.
    """
    cores = log.sparkSession.sparkContext.defaultParallelism
    similarities, items = sim.agg(F.count(F.lit(1)), F.countDistinct("item_i")).first()
    rows, n_users = log.agg(F.count(F.lit(1)), F.countDistinct("user_id")).first()
    down, across = grid(rows, n_users, n, similarities, items, cores, held, products)
    users = log.groupBy("user_id").agg(F.sort_array(F.collect_list("item_id")).alias("items"))
    user_block = F.pmod(F.xxhash64("user_id"), F.lit(down)).cast("int")
    each = F.explode(F.transform(F.sequence(F.lit(0), F.lit(across - 1)), lambda i: user_block * across + i)).alias("block")
    item_block = F.pmod(F.xxhash64("item_j"), F.lit(across)).cast("int").alias("ib")
    pairs = F.collect_list(F.struct("item_j", "similarity")).alias("e")
    packed = sim.groupBy(F.col("item_i").alias("id"), item_block).agg(pairs)

    def blocks(histories: DataFrame, bar: Column) -> DataFrame:
        near = packed.select(
            F.explode(F.transform(F.sequence(F.lit(0), F.lit(down - 1)), lambda u: u * across + F.col("ib"))).alias("block"),
            F.lit(0).alias("kind"),
            "id",
            F.col("e.item_j").alias("items"),
            F.col("e.similarity").alias("weights"),
        )
        sent = histories.select(each, F.lit(1).alias("kind"), F.col("user_id").alias("id"), "items", F.array(bar).alias("weights"))
        return near.unionByName(sent).repartitionById(down * across, "block").sortWithinPartitions("kind")

    bar = F.lit(float("-inf"))
    if across > 1 and n_users * n * across > bar_rows:
        users, packed, m = materialize(users), materialize(packed), math.ceil(n / across)
        found = blocks(users, bar).mapInArrow(lambda b: _lists_of(b, m, bars=True), "user_id bigint, bar double")
        bars = materialize(found.groupBy(F.col("user_id").alias("_user")).agg(F.min("bar").alias("bar")))
        users, bar = users.join(bars, F.col("user_id").eqNullSafe(F.col("_user"))), F.col("bar")
    return blocks(users, bar).mapInArrow(lambda b: _lists_of(b, n), "user_id bigint, item_id bigint, score double")
