"""Candidate lists per user: top N of a scorer, next-item pairs, ALS, and their union."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelrank.functions.calendar import seconds_of
from reelrank.operators import bm25, packed
from reelrank.operators.bm25 import SCORE_DIGITS
from reelrank.operators.clean import dense_ids, user_watch_counts
from reelrank.operators.skew import HotKeys, hot_keys, next_in_order, number_rows, skew_join
from reelrank.session import materialize, view_source

# Fixed values of the next-item recommender.
SUCCESSORS = 500
NEXT_ITEM_LIST = 300
FALLBACK_ITEMS = 6
# Rows that a task expands or groups into lists.
LIST_ROWS = 500_000
# Fixed values of the factor model; rounds and regularisation are our choice.
ALS_RANK = 20
ALS_ALPHA = 13.0
ALS_SEED = 42
# Log rows per block of the fit; log rows and items per block of the scoring, score cells held at a time.
ALS_BLOCK_ROWS = 2_000_000
USER_BLOCK_ROWS = 4_000_000
ITEM_BLOCK = 100_000
SCORE_CELLS = 4_000_000


@dataclass(frozen=True)
class Budget:
    """Length of a candidate list: users with fewer than ``threshold`` watches get ``few``."""

    few: int = 800
    many: int = 400
    threshold: int = 2

    @property
    def longest(self) -> int:
        return max(self.few, self.many)


def ordered_top(scores: DataFrame, n: int, out: str = "rank") -> DataFrame:
    """Top n per user by score, ties by the lower item; each task cuts its rows before the shuffle."""
    order = Window.partitionBy("user_id").orderBy(F.desc(F.round("score", SCORE_DIGITS)), "item_id")
    return scores.withColumn(out, F.row_number().over(order)).where(F.col(out) <= n)


def within_budget(scores: DataFrame, log: DataFrame, budget: Budget) -> DataFrame:
    """Top list per user, its length set by the user's number of watches."""
    return cut_to_budget(ordered_top(scores, budget.longest), log, budget)


def cut_to_budget(lists: DataFrame, log: DataFrame, budget: Budget) -> DataFrame:
    """The start of every list that the budget allows; ``lists`` with ranks, as long as the budget's longest at least."""
    short = lists.where(F.col("rank") <= budget.longest)
    if budget.few == budget.many:
        return short
    return short.join(user_watch_counts(log), "user_id").where(F.col("rank") <= _allowed(budget)).drop("n")


def _allowed(budget: Budget) -> Column:
    """Length of the list of a user with ``n`` watches."""
    return F.when(F.col("n") < budget.threshold, budget.few).otherwise(budget.many)


def bm25_candidates(log: DataFrame, sim: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """(user_id, item_id, score, rank) from item neighbours, unseen items only; ``sim`` a stored table."""
    held = view_source(sim)
    if isinstance(held, packed.Packed):
        lengths = None if budget.few == budget.many else user_watch_counts(log).select("user_id", _allowed(budget).alias("allowed"))
        return packed.ranked_lists(log, held, budget.longest, lengths)
    return within_budget(bm25.neighbour_lists(log, sim, budget.longest), log, budget)


def user_history(log: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """The user's items in order of time, one row per position (1 = oldest)."""
    timed = log.select("user_id", "item_id", seconds_of(F.col("ts")).alias("_s"), "ts")
    return number_rows(timed, ["user_id"], "_s", ["ts", "item_id"], "position", hot).select(
        "user_id", "position", "item_id"
    )


def successor_pairs(log: DataFrame, limit: int = SUCCESSORS, hot: HotKeys | None = None) -> DataFrame:
    """How often an item directly follows another in a user's sequence; top ``limit`` per item."""
    timed = log.select("user_id", "item_id", seconds_of(F.col("ts")).alias("_s"), "ts")
    stepped = next_in_order(timed, "user_id", "_s", ["ts", "item_id"], "item_id", "next_item", hot)
    counts = (
        stepped.where(F.col("next_item").isNotNull())
        .groupBy("item_id", "next_item")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("item_id").orderBy(F.desc("n"), "next_item")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def popular_items(log: DataFrame, n: int) -> DataFrame:
    """The n most watched items with their position, at most n rows."""
    top = log.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "item_id").limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "item_id")))


def successor_candidates(
    log: DataFrame,
    pairs: DataFrame,
    item_index: int = 0,
    num_recs: int = NEXT_ITEM_LIST,
    fallback: int = FALLBACK_ITEMS,
    list_rows: int = LIST_ROWS,
) -> DataFrame:
    """What usually follows the user's item ``item_index`` from the end, unseen items only.

    A last item nothing ever followed gets the most popular items with score 0.
    (user_id, item_id, score, rank), ranks from 1. The lists are made and cut in as many tasks as keep about
    ``list_rows`` rows each, since a task that reads a megabyte of last items may write a gigabyte of lists.
    """
    latest = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("item_id"))
    last = (
        log.withColumn("_back", F.row_number().over(latest))
        .where(F.col("_back") == item_index + 1)
        .select("user_id", "item_id")
    )
    last, pairs = materialize(last), materialize(pairs.select("item_id", "next_item", "n"))
    follow = pairs.select("item_id", "next_item", F.col("n").cast("double").alias("score"))
    # One row per item; a short table of last items grows by the lengths of the lists.
    lengths = pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("_m"))
    grown = last.groupBy("item_id").agg(F.count(F.lit(1)).alias("_n")).join(lengths, "item_id")
    expanded, longest = grown.agg(F.sum(F.col("_n") * F.col("_m")), F.max("_m")).first()
    expanded, longest = expanded or 0, longest or 1
    hot = hot_keys(last, ["item_id"], max(1, list_rows // longest))
    known = skew_join(last, follow, ["item_id"], "inner", hot, ["user_id"], _parts(expanded, list_rows)).select(
        "user_id", F.col("next_item").alias("item_id"), "score", F.lit(0).alias("place")
    )
    # ``fallback`` rows as one array value, so the users without a known last item need no cross join.
    popular = popular_items(log, fallback).agg(
        F.array_sort(F.collect_list(F.struct(F.col("rank").alias("place"), "item_id")))
    )
    unknown = (
        skew_join(last, pairs.select("item_id").distinct(), ["item_id"], "left_anti", hot, ["user_id"])
        .select("user_id", F.explode(popular.scalar()).alias("p"))
        .select("user_id", "p.item_id", F.lit(0.0).alias("score"), "p.place")
    )
    nothing = F.lit(None)
    seen = log.select("user_id", "item_id", nothing.cast("double").alias("score"), nothing.cast("int").alias("place"))
    unseen = (
        known.unionByName(unknown)
        .withColumn("seen", F.lit(0))
        .unionByName(seen.withColumn("seen", F.lit(1)))
        .repartition(_parts(expanded + log.count(), list_rows), "user_id", "item_id")
        .groupBy("user_id", "item_id")
        .agg(F.max("score").alias("score"), F.max("place").alias("place"), F.max("seen").alias("seen"))
        .where(F.col("seen") == 0)
    )
    order = Window.partitionBy("user_id").orderBy(F.desc("score"), "place", "item_id")
    return (
        unseen.repartition(_parts(expanded, list_rows), "user_id")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= num_recs)
        .select("user_id", "item_id", "score", "rank")
    )


def _parts(rows: int, rows_per_task: int) -> int:
    return max(1, math.ceil(rows / rows_per_task))


def successor_recommendations(candidates: DataFrame, item_index: int = 0) -> DataFrame:
    """The list under the column names of its item index, ranks from 0."""
    return candidates.select(
        "user_id",
        "item_id",
        F.col("score").alias(f"cooc_score_{item_index}"),
        (F.col("rank") - 1).alias(f"cooc_rank_{item_index}"),
    )


def fit_als(
    log: DataFrame,
    rank: int = ALS_RANK,
    alpha: float = ALS_ALPHA,
    seed: int = ALS_SEED,
    max_iter: int = 15,
    reg_param: float = 0.01,
    block_rows: int = ALS_BLOCK_ROWS,
) -> tuple[ALSModel, DataFrame, DataFrame]:
    """Implicit ALS (Hu, Koren & Volinsky 2008) on the deduplicated log.

    Returns the model and the two id tables: ALS wants 32-bit ids, so users and items are numbered.
    """
    users = dense_ids(log, "user_id", "user_idx")
    items = dense_ids(log, "item_id", "item_idx")
    indexed = materialize(indexed_log(log, users, items))
    # As many blocks as the log asks for, and one for every core at least.
    blocks = max(log.sparkSession.sparkContext.defaultParallelism, math.ceil(indexed.count() / block_rows))
    als = ALS(
        userCol="user_idx",
        itemCol="item_idx",
        ratingCol="rating",
        implicitPrefs=True,
        rank=rank,
        alpha=alpha,
        seed=seed,
        maxIter=max_iter,
        regParam=reg_param,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=5,
        coldStartStrategy="drop",
    )
    return als.fit(indexed), users, items


def indexed_log(log: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    pairs = log.select("user_id", "item_id")
    by_user = skew_join(pairs, users, ["user_id"], "inner", hot_keys(pairs, ["user_id"]), ["item_id"])
    both = skew_join(by_user, items, ["item_id"], "inner", hot_keys(pairs, ["item_id"]), ["user_id"])
    return both.select(
        F.col("user_idx").cast("int").alias("user_idx"),
        F.col("item_idx").cast("int").alias("item_idx"),
        F.lit(1.0).alias("rating"),
    )


def als_factors(model: ALSModel, items: DataFrame) -> DataFrame:
    """(item_id, factor) of the fitted model."""
    return model.itemFactors.join(items, F.col("id") == F.col("item_idx")).select(
        "item_id", F.col("features").cast("array<double>").alias("factor")
    )


def _best_unseen(n: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Best n unseen items of one block of items for every user of one block of users."""

    def block(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("item_idx", ignore_index=True)
        items = right["item_idx"].to_numpy()
        users = left[left["item_idx"].isna()].sort_values("user_idx", ignore_index=True)
        # What users have seen who have no place for an item of this block does not matter.
        seen = left[left["item_idx"].notna() & left["user_idx"].isin(users["user_idx"])].sort_values("user_idx")
        ids, seen_by = users["user_idx"].to_numpy(), seen["user_idx"].to_numpy()
        width, found = len(items), []
        empty = pd.DataFrame({"user_idx": np.zeros(0, "int32"), "item_idx": np.zeros(0, "int32"), "score": np.zeros(0)})
        if not width or not len(ids):
            return empty
        vectors = np.stack(right["f"].to_numpy()).astype(float).T
        place = np.searchsorted(items, seen["item_idx"].to_numpy())
        step = max(1, SCORE_CELLS // width)
        for low in range(0, len(ids), step):
            own = ids[low : low + step]
            score = np.stack(users["f"].to_numpy()[low : low + step]).astype(float) @ vectors
            some = slice(*np.searchsorted(seen_by, [own[0], own[-1] + 1]))
            by = np.round(score, SCORE_DIGITS)
            by[np.searchsorted(own, seen_by[some]), place[some]] = -np.inf
            # Everything down to the n-th stays; the window that cuts the lists settles ties by item.
            least = np.partition(by, width - n, axis=1)[:, width - n] if width > n else np.full(len(own), -np.inf)
            row, col = np.nonzero((by >= least[:, None]) & np.isfinite(by))
            order = np.lexsort((col, -by[row, col], row))
            row, col = row[order], col[order]
            kept = np.arange(len(row)) - np.searchsorted(row, row) < n
            row, col = row[kept], col[kept]
            found.append(pd.DataFrame({"user_idx": own[row], "item_idx": items[col], "score": by[row, col]}))
        return pd.concat([empty, *found])

    return block


# A bound on a product of factors is taken a little larger, for the digits that rounding may add.
BOUND_SLACK = 1e-6


@dataclass(frozen=True)
class BestUnseen:
    """``lists`` (user_idx, item_idx, score): the n best unseen items of every user are among the rows; and the number of
    (user, item block) pairs that were scored, of all there are."""

    lists: DataFrame
    scored: int
    pairs: int


def best_unseen(
    users: DataFrame, items: DataFrame, seen: DataFrame, n: int, user_block_rows: int = USER_BLOCK_ROWS, item_block: int = ITEM_BLOCK
) -> BestUnseen:
    """The unseen items with the greatest inner product, exactly, without scoring what cannot be among them.

    ``users`` (user_idx, f), ``items`` (item_idx, f), ``seen`` (user_idx, item_idx), all stored tables. A blocked matrix product:
    users in blocks of about ``user_block_rows`` seen rows, items in blocks of about ``item_block`` by falling length of their
    factors. The first block gives every user an n-th best score. A product is at most the product of the lengths, so
    of the other blocks a user is sent only to those whose longest item could still reach that score; they come first, since
    lengths fall. What a user has seen goes to the block of the item and is struck out there, so only the best N per user and
    block leave a task, for any length of history.
    """

    def size(f: str) -> Column:
        return F.sqrt(F.aggregate(f, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))

    n_users, n_items = users.count(), items.count()
    across = max(1, math.ceil(seen.count() / user_block_rows))
    down = max(1, math.ceil(n_items / item_block))
    # A small job cuts the items further, until every core has a block to work on.
    down = max(down, min(math.ceil(seen.sparkSession.sparkContext.defaultParallelism / across), max(1, n_items)))
    ordered = number_rows(items.withColumns({"_all": F.lit(0), "_size": -size("f")}), ["_all"], "_size", ["item_idx"], "_nth")
    per_block = max(1, math.ceil(n_items / down))
    placed = materialize(ordered.withColumn("ib", F.floor((F.col("_nth") - 1) / per_block).cast("int")).select("item_idx", "f", "ib", "_size"))
    # One number per block, longest first.
    tops = placed.groupBy("ib").agg(F.max(-F.col("_size")).alias("top"))
    tops = tops.agg(F.transform(F.array_sort(F.collect_list(F.struct("ib", "top"))), lambda b: b["top"])).scalar()

    def user_block(column: str = "user_idx") -> Column:
        return F.pmod(F.xxhash64(F.col(column).cast("int")), F.lit(across)).cast("int").alias("ub")

    struck = seen.join(placed.select("item_idx", "ib"), "item_idx").select(
        user_block(), "ib", "user_idx", "item_idx", F.lit(None).cast("array<float>").alias("f")
    )
    struck = materialize(struck)
    each = F.explode(F.sequence(F.lit(0), F.lit(across - 1))).alias("ub")
    offered = placed.select(each, "ib", "item_idx", "f")
    none = F.lit(None).cast("int").alias("item_idx")

    def scored(asked: DataFrame, first: bool) -> DataFrame:
        some = (F.col("ib") == 0) if first else (F.col("ib") > 0)
        rows = asked.select(user_block(), "ib", "user_idx", none, "f").unionByName(struck.where(some))
        pairs = rows.groupBy("ub", "ib").cogroup(offered.where(some).groupBy("ub", "ib"))
        return materialize(pairs.applyInPandas(_best_unseen(n), "user_idx int, item_idx int, score double"))

    near = scored(users.withColumn("ib", F.lit(0)), True)
    nth = near.groupBy("user_idx").agg(F.count(F.lit(1)).alias("held"), F.min("score").alias("least"))
    reach = size("f") * (1 + BOUND_SLACK)
    bar = F.when(F.col("held") >= n, F.col("least") - BOUND_SLACK).otherwise(float("-inf"))
    # Lengths fall, so the blocks that may matter are the first ones.
    upto = F.size(F.filter("_tops", lambda top: top * F.col("_reach") >= F.col("_bar"))) - 1
    asked = users.join(nth, "user_idx", "left").withColumns(
        {"_reach": reach, "_bar": F.coalesce(bar, F.lit(float("-inf"))), "_tops": tops}
    )
    asked = materialize(asked.withColumn("_upto", upto).where(F.col("_upto") > 0).select("user_idx", "f", "_upto"))
    more = asked.select("user_idx", "f", F.explode(F.sequence(F.lit(1), "_upto")).alias("ib"))
    far = scored(more, False)
    done = asked.agg(F.coalesce(F.sum("_upto"), F.lit(0))).first()[0] + n_users
    return BestUnseen(near.unionByName(far), done, n_users * math.ceil(n_items / per_block))


def als_candidates(
    log: DataFrame,
    fitted: tuple[ALSModel, DataFrame, DataFrame],
    budget: Budget = Budget(),
    user_block_rows: int = USER_BLOCK_ROWS,
    item_block: int = ITEM_BLOCK,
) -> DataFrame:
    """(user_id, item_id, score, rank) from the factor model, unseen items only.

    Numbers stand in for the ids until the lists are cut; they are in the order of the ids, so ties fall the same way.
    """
    model, users, items = fitted
    seen = materialize(indexed_log(log, users, items)).select("user_idx", "item_idx")
    known = materialize(model.userFactors.select(F.col("id").alias("user_idx"), F.col("features").alias("f")))
    offered = materialize(model.itemFactors.select(F.col("id").alias("item_idx"), F.col("features").alias("f")))
    found = best_unseen(known, offered, seen, budget.longest, user_block_rows, item_block)
    unseen = found.lists.withColumnsRenamed({"user_idx": "user_id", "item_idx": "item_id"})
    numbers = seen.select(F.col("user_idx").alias("user_id"))
    lists = materialize(within_budget(unseen, numbers, budget)).withColumnsRenamed(
        {"user_id": "user_idx", "item_id": "item_idx"}
    )
    # A popular item is on most lists.
    named = skew_join(lists, items, ["item_idx"], "inner", hot_keys(lists, ["item_idx"]), ["user_idx"])
    return named.join(users, "user_idx").select("user_id", "item_id", "score", "rank")


def candidate_union(first: DataFrame, second: DataFrame, first_name: str, second_name: str = "nn") -> DataFrame:
    """Both lists side by side: score and reciprocal rank of each, null where a list lacks the item.

    Stacked and grouped rather than joined: one shuffle by (user, item).
    """

    def side(df: DataFrame, mine: str, other: str) -> DataFrame:
        return df.select(
            "user_id",
            "item_id",
            F.col("score").alias(f"{mine}_score"),
            (1.0 / F.col("rank")).alias(f"{mine}_rank"),
            F.lit(None).cast("double").alias(f"{other}_score"),
            F.lit(None).cast("double").alias(f"{other}_rank"),
        )

    columns = [f"{first_name}_score", f"{first_name}_rank", f"{second_name}_score", f"{second_name}_rank"]
    return (
        side(first, first_name, second_name)
        .unionByName(side(second, second_name, first_name))
        .groupBy("user_id", "item_id")
        .agg(*[F.max(c).alias(c) for c in columns])
    )
