"""Result tables behind the exploratory charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelrank.operators.clean import user_watch_counts

# Ten bins of ten per cent; items and the least-watches steps of the charts.
BIN_WIDTH = 10
TOP_ITEMS = 100
MOST_WATCHES = 40
# Shares are compared after rounding, so a share on a bin edge is on it in every engine.
SHARE_DIGITS = 9


def weekly_interactions(log: DataFrame) -> DataFrame:
    return log.groupBy(F.weekofyear("ts").alias("week_number")).agg(F.count(F.lit(1)).alias("n"))


def users_by_min_history(log: DataFrame, most: int = MOST_WATCHES) -> DataFrame:
    """Users with more than i rows for i = 0..most: one pass, ``most`` + 1 counters."""
    counts = user_watch_counts(log)
    counters = counts.agg(
        *[F.count(F.when(F.col("n") > i, 1)).alias(f"_{i}") for i in range(most + 1)]
    )
    steps = F.array(*[F.struct(F.lit(i).alias("min_views"), F.col(f"_{i}").alias("n_users")) for i in range(most + 1)])
    return counters.select(F.inline(steps))


def watch_share_histogram(shares: DataFrame) -> DataFrame:
    """Rows per ten per cent of the item watched; a share on an edge counts in both bins."""
    percent = F.round(F.col("percent_of_watch") * 100, SHARE_DIGITS)
    bins = range(BIN_WIDTH, 101, BIN_WIDTH)
    counters = shares.agg(*[F.count(F.when(percent.between(b - BIN_WIDTH, b), 1)).alias(f"_{b}") for b in bins])
    rows = F.array(
        *[F.struct(F.lit(f"{b - BIN_WIDTH}-{b}").alias("bin"), F.col(f"_{b}").alias("n")) for b in bins]
    )
    return counters.select(F.inline(rows))


def top_items_weekly_views(log: DataFrame, views: DataFrame, top: int = TOP_ITEMS, week: int | None = None) -> DataFrame:
    """Rows per week of the most viewed items, at most ``top`` of them.

    ``week`` keeps the items that were watched in that week of the year.
    """
    best = views.orderBy(F.desc("views"), "item_id").limit(top).select("item_id")
    weekly = (
        log.join(F.broadcast(best), "item_id", "left_semi")
        .groupBy("item_id", F.weekofyear("ts").alias("week_number"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if week is None:
        return weekly
    # One row per item and week of the year, 53 at most for each of the top items.
    on = Window.partitionBy("item_id")
    present = F.max(F.when(F.col("week_number") == week, 1).otherwise(0)).over(on)
    return weekly.withColumn("_in", present).where(F.col("_in") == 1).drop("_in")
