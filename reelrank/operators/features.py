"""Item features from the deduplicated log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.functions.scoring import RATINGS, activation, hamming_trend_weights, implied_rating, percentage
from reelrank.operators.clean import mean_duration, total_duration
from reelrank.operators.skew import HotKeys, exact_quantiles, hot_keys, skew_join
from reelrank.session import materialize

# Fixed value: the quantile of the watch times taken as the length of an item.
LENGTH_QUANTILE = 0.9
TREND_WINDOW = 7

ITEM_FEATURES = [
    "approx_duration",
    "mean_duration",
    "mean_percentage",
    *[f"rating_{r}" for r in RATINGS],
    "mean_score",
    "median_score",
    "std_score",
    "q25_score",
    "q75_score",
    "trend_slope",
    "watched_in_window",
]


def item_duration_stats(log: DataFrame, items: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Approximate length, mean duration and mean percentage of every item; null without watches."""
    length = exact_quantiles(log, "item_id", "duration", {"approx_duration": LENGTH_QUANTILE}, hot)
    mean = log.groupBy("item_id").agg(mean_duration().alias("mean_duration"))
    return (
        items.select("item_id")
        .join(length, "item_id", "left")
        .join(mean, "item_id", "left")
        .withColumn("mean_percentage", percentage(F.col("mean_duration"), F.col("approx_duration")))
    )


def percent_of_watch(log: DataFrame, durations: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Share of the item's length that was watched; 0 for an item without a row in ``durations``."""
    hot = hot_keys(log, ["item_id"]) if hot is None else hot
    lengths = durations.select("item_id", "approx_duration", F.lit(True).alias("_known"))
    joined = skew_join(log, lengths, ["item_id"], "left", hot, ["user_id"])
    share = F.when(F.col("_known"), F.try_divide("duration", "approx_duration")).otherwise(F.lit(0.0))
    return joined.withColumn("percent_of_watch", share).drop("approx_duration", "_known")


def scored(log: DataFrame, durations: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Share watched, activation score and implied rating on every log row."""
    shares = percent_of_watch(log, durations, hot)
    return shares.withColumn("score", activation(F.col("percent_of_watch"))).withColumn(
        "rating", implied_rating(F.col("score"))
    )


def item_score_stats(scores: DataFrame, items: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Mean, median, sample deviation and quartiles of the scores of every item."""
    moments = scores.groupBy("item_id").agg(
        F.avg("score").alias("mean_score"), F.stddev_samp("score").alias("std_score")
    )
    quantiles = exact_quantiles(
        scores, "item_id", "score", {"q25_score": 0.25, "median_score": 0.5, "q75_score": 0.75}, hot
    )
    return (
        items.select("item_id")
        .join(moments, "item_id", "left")
        .join(quantiles, "item_id", "left")
        .select("item_id", "mean_score", "median_score", "std_score", "q25_score", "q75_score")
    )


def item_rating_shares(scores: DataFrame, items: DataFrame) -> DataFrame:
    """Share of each rating among the rated rows of every item; null without any."""
    shares = scores.groupBy("item_id").agg(
        *[
            F.try_divide(F.count(F.when(F.col("rating") == r, 1)), F.count("rating")).alias(f"rating_{r}")
            for r in RATINGS
        ]
    )
    return items.select("item_id").join(shares, "item_id", "left")


def item_trend(log: DataFrame, items: DataFrame, window: int = TREND_WINDOW) -> DataFrame:
    """Trend slope and number of watches of every item over the last ``window`` days of the log.

    The smoothing is linear in the daily counts, so each watch simply adds the weight of its day.
    """
    day = F.datediff(F.col("ts").cast("date"), F.lit(dt.date(1970, 1, 1)))
    last = log.agg(F.max("ts").alias("m")).select(F.datediff(F.col("m").cast("date"), F.lit(dt.date(1970, 1, 1)))).scalar()
    weights = hamming_trend_weights(window)
    recent = log.select("item_id", (day - last + window - 1).alias("_slot")).where(F.col("_slot") >= 0)
    counts = recent.groupBy("item_id").agg(
        *[F.count(F.when(F.col("_slot") == k, 1)).alias(f"_d{k}") for k in range(window)]
    )
    slope, total = F.lit(0.0), F.lit(0)
    for k, w in enumerate(weights):
        count = F.coalesce(F.col(f"_d{k}"), F.lit(0))
        slope, total = slope + F.lit(w) * count, total + count
    return (
        items.select("item_id")
        .join(counts, "item_id", "left")
        .select("item_id", slope.alias("trend_slope"), total.cast("bigint").alias("watched_in_window"))
    )


def item_popularity(log: DataFrame, items: DataFrame) -> DataFrame:
    """Number of watches, summed and mean duration of every item, 0 without watches."""
    stats = log.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("popularity"),
        total_duration().alias("sum_watch_time"),
        mean_duration().alias("mean_watch_time"),
    )
    return (
        items.select("item_id")
        .join(stats, "item_id", "left")
        .na.fill(0, ["popularity", "sum_watch_time", "mean_watch_time"])
    )


def item_feature_table(
    all_log: DataFrame,
    history: DataFrame,
    items: DataFrame,
    window: int = TREND_WINDOW,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The item features of the ranker: lengths from ``all_log``, scores and trend from ``history``.

    ``hot`` holds the hot items of ``all_log``; they cover those of ``history``, a part of it.
    """
    hot = hot_keys(all_log, ["item_id"]) if hot is None else hot
    durations = materialize(item_duration_stats(all_log, items, hot))
    # Three aggregations read the scores; two numbers per log row are cheaper to store than to join again.
    scores = materialize(scored(history, durations, hot).select("item_id", "score", "rating"))
    return (
        durations.join(item_rating_shares(scores, items), "item_id", "full")
        .join(item_score_stats(scores, items, hot), "item_id", "full")
        .join(item_trend(history, items, window), "item_id", "full")
        .select("item_id", *ITEM_FEATURES)
    )
