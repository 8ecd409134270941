"""Whole jobs: prepare, train, recommend, evaluate."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.ml import PipelineModel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelrank.functions.text import CYRILLIC, clean_text
from reelrank.operators import bm25, candidates, clean, coldstart, evaluate, features, ranker, similarity, splits, training
from reelrank.operators.candidates import Budget
from reelrank.operators.skew import HotKeys, hot_keys
from reelrank.session import materialize
from reelrank.sources.dataset import Dataset


@dataclass(frozen=True)
class Config:
    """Parameters of a run; the defaults are the production profile."""

    users_watches_threshold: int = 0
    items_views_threshold: int = 0
    budget: Budget = field(default_factory=Budget)
    weeks_for_ranker: int = 2
    weeks_for_local: int = 1
    cold_start: str = "local"
    train_size: float = 0.999999999999
    neighbours: int = bm25.NEIGHBOURS
    trend_window: int = features.TREND_WINDOW
    alphabet: str = CYRILLIC
    top_n: int = coldstart.TOP_N
    seed: int = training.SEED
    rounds: int = ranker.ROUNDS
    loss: str = "grouped"
    als_iterations: int = 15


# The two shipped parameter sets.
PRODUCTION = Config(budget=Budget(few=800, many=400, threshold=2))
EXPLORATION = Config(budget=Budget(few=100, many=100, threshold=4))


@dataclass(frozen=True)
class Prepared:
    """Deduplicated log of known items and the item tables every later step reads."""

    log: DataFrame
    items: DataFrame
    views: DataFrame
    texts: DataFrame
    hot_users: HotKeys
    hot_items: HotKeys


@dataclass(frozen=True)
class FirstStage:
    """Both candidate models fitted on one log, and their lists."""

    log: DataFrame
    similarity: DataFrame
    factors: DataFrame
    union: DataFrame
    als: tuple[ALSModel, DataFrame, DataFrame]


@dataclass(frozen=True)
class Trained:
    ranker: PipelineModel
    numeric: list[str]
    without_hits: DataFrame
    split: DataFrame


def prepare(dataset: Dataset, config: Config = PRODUCTION) -> Prepared:
    raw = clean.typed_log(dataset.log)
    views = materialize(clean.items_by_views(clean.item_views(raw, dataset.items), config.items_views_threshold))
    # Stored: every later step reads the items, none the raw log again.
    items = materialize(dataset.items.join(views.select("item_id"), "item_id", "left_semi"))
    log = clean.dedupe(clean.known_items(raw, items))
    log = materialize(clean.keep_active_users(log, config.users_watches_threshold))
    roles = clean.staff_by_role(items, dataset.staff)
    texts = training.item_text_features(
        items,
        clean.staff_text(roles),
        items.select("item_id", clean_text(F.col("description"), config.alphabet).alias("text")),
        clean.genre_count(items),
    )
    return Prepared(
        log,
        items,
        views,
        materialize(texts),
        hot_keys(log, ["user_id"]),
        hot_keys(log, ["item_id"]),
    )


def first_stage(log: DataFrame, config: Config) -> FirstStage:
    """Fit item neighbours and factors on ``log`` and propose candidates for all its users."""
    sim = materialize(bm25.item_similarity(log, config.neighbours))
    near = candidates.bm25_candidates(log, sim, config.budget)
    als = candidates.fit_als(log, seed=config.seed, max_iter=config.als_iterations)
    factored = candidates.als_candidates(log, als, config.budget)
    union = materialize(candidates.candidate_union(factored, near, "als"))
    return FirstStage(log, sim, candidates.als_factors(als[0], als[2]), union, als)


def features_for(
    rows: DataFrame, stage: FirstStage, prepared: Prepared, history: DataFrame, config: Config
) -> DataFrame:
    """Feature table of the given candidates; relative scores are taken over the full lists."""
    items = prepared.items.select("item_id")
    popularity = features.item_popularity(history, items)
    item_features = features.item_feature_table(
        prepared.log, history, items, config.trend_window, prepared.hot_items
    )
    keys = rows.select("user_id", "item_id")
    stats = [
        similarity.bm25_similarity_stats(keys, stage.log, stage.similarity),
        similarity.factor_similarity_stats(keys, stage.log, stage.factors),
    ]
    relative = training.normalised_scores(stage.union, popularity, "als").join(keys, ["user_id", "item_id"], "left_semi")
    return training.candidate_features(relative, materialize(item_features), prepared.texts, stats, "als")


def train(prepared: Prepared, config: Config = PRODUCTION) -> Trained:
    """Fit the ranker: candidates from d1, labels from d2."""
    d1, d2 = splits.train_target(prepared.log, config.weeks_for_ranker, prepared.hot_users)
    d1, d2 = materialize(d1.drop("week_idx")), materialize(d2.drop("week_idx"))
    stage = first_stage(d1, config)
    rows = materialize(training.labelled(stage.union, d2, "als"))
    without_hits = training.users_without_hits(d2, training.candidate_hits(rows))
    split = training.user_split(d2, config.train_size, config.seed)
    sample = materialize(training.ranker_training_set(rows, config.seed))
    table = features_for(sample, stage, prepared, d1, config)
    table = table.join(sample.select("user_id", "item_id", "label"), ["user_id", "item_id"])
    table = table.join(split.where(F.col("part") == "train"), "user_id", "left_semi")
    numeric = training.numeric_features(table.columns, "als")
    model = ranker.fit_ranker(table, numeric, rounds=config.rounds, seed=config.seed, loss=config.loss)
    return Trained(model, numeric, materialize(without_hits), split)


def fill_up(ranked: DataFrame, fallback: DataFrame, top_n: int) -> DataFrame:
    """Lists from ``ranked`` closed up to ``top_n`` with ``fallback``; nothing occurs twice.

    Both inputs hold at most ``top_n`` rows per user.
    """
    both = ranked.select("user_id", "item_id", "rank", F.lit(0).alias("turn"), F.lit("ranked").alias("source")).unionByName(
        fallback.select("user_id", "item_id", "rank", F.lit(1).alias("turn"), F.lit("cold_start").alias("source"))
    )
    once = both.groupBy("user_id", "item_id").agg(F.min(F.struct("turn", "rank", "source")).alias("best"))
    order = Window.partitionBy("user_id").orderBy("best.turn", "best.rank", "item_id")
    return (
        once.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top_n)
        .select("user_id", "rank", "item_id", F.col("best.source").alias("source"))
    )


def scores(
    prepared: Prepared, trained: Trained, config: Config = PRODUCTION, users: DataFrame | None = None
) -> DataFrame:
    """Ranker score of every candidate of the users it can serve; candidates are refitted on the whole log."""
    stage = first_stage(prepared.log, config)
    served = stage.union.join(trained.without_hits, "user_id", "left_anti")
    if users is not None:
        served = served.join(users.select("user_id").distinct(), "user_id", "left_semi")
    table = features_for(served, stage, prepared, prepared.log, config)
    return ranker.ranker_scores(trained.ranker, table)


def lists_from(
    prepared: Prepared, scored: DataFrame, config: Config = PRODUCTION, users: DataFrame | None = None
) -> DataFrame:
    """Top lists for all users of the log (or ``users``): ranker where it can serve, else popular items."""
    wanted = prepared.log.select("user_id").distinct() if users is None else users.select("user_id").distinct()
    ranked = ranker.top_per_user(scored, config.top_n)
    local = materialize(coldstart.local_top_items(prepared.log, config.weeks_for_local))
    if config.cold_start == "global":
        fallback = coldstart.cold_start_global(
            prepared.log, prepared.items, prepared.views, local, wanted, config.top_n, prepared.hot_users, prepared.hot_items
        )
    else:
        fallback = coldstart.cold_start_local(prepared.log, prepared.items, local, wanted, config.top_n, prepared.hot_items)
    return fill_up(ranked, fallback, config.top_n)


def recommend(
    prepared: Prepared, trained: Trained, config: Config = PRODUCTION, users: DataFrame | None = None
) -> DataFrame:
    return lists_from(prepared, scores(prepared, trained, config, users), config, users)


def recommend_neighbours(
    log: DataFrame,
    items: DataFrame,
    neighbours: int = bm25.NEIGHBOURS,
    top_n: int = coldstart.TOP_N,
    weeks_for_local: int = 1,
) -> DataFrame:
    """Top lists from item neighbours alone, filled up with locally popular items."""
    hot_items = hot_keys(log, ["item_id"])
    sim = materialize(bm25.item_similarity(log, neighbours))
    ranked = candidates.bm25_candidates(log, sim, Budget(top_n, top_n, 0))
    local = coldstart.local_top_items(log, weeks_for_local)
    fallback = coldstart.cold_start_local(log, items, local, top_n=top_n, hot_items=hot_items)
    return fill_up(ranked, fallback, top_n)


def run(dataset: Dataset, config: Config = PRODUCTION) -> DataFrame:
    """From raw tables to recommendations."""
    prepared = prepare(dataset, config)
    return recommend(prepared, train(prepared, config), config)


def offline_test(dataset: Dataset, config: Config = PRODUCTION) -> DataFrame:
    """MAP@k on the last weeks: everything before them is the log, the cut-off weeks are the truth."""
    prepared = prepare(dataset, config)
    rest = materialize(splits.before_last_weeks(prepared.log, splits.HOLDOUT_WEEKS).drop("week_idx"))
    known = replace(prepared, log=rest)
    # Test users are those the ranker's candidates come from.
    d1, _ = splits.train_target(rest, config.weeks_for_ranker, prepared.hot_users)
    truth = splits.of_users(splits.last_weeks(prepared.log, splits.HOLDOUT_WEEKS), d1, prepared.hot_users)
    predicted = recommend(known, train(known, config), config, truth)
    return evaluate.map_at_k(evaluate.average_precision(predicted, truth, config.top_n))
