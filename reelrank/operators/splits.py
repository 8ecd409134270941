"""Splits by week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.functions.calendar import week_index
from reelrank.operators.skew import HotKeys, hot_keys, skew_join

HOLDOUT_WEEKS = 2


def with_week(log: DataFrame) -> DataFrame:
    return log.withColumn("week_idx", week_index(F.col("ts")))


def last_week(log: DataFrame):
    """Greatest week of the log as a scalar subquery; a one-row aggregate, no join."""
    return log.agg(week_index(F.max("ts")).alias("w")).scalar()


def before_last_weeks(log: DataFrame, weeks: int) -> DataFrame:
    return with_week(log).where(F.col("week_idx") < last_week(log) - weeks)


def last_weeks(log: DataFrame, weeks: int) -> DataFrame:
    """The last ``weeks`` + 1 calendar weeks."""
    return with_week(log).where(F.col("week_idx") >= last_week(log) - weeks)


def of_users(log: DataFrame, other: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Log rows of users that also occur in ``other``."""
    hot = hot_keys(log, ["user_id"]) if hot is None else hot
    return skew_join(log, other.select("user_id").distinct(), ["user_id"], "left_semi", hot, ["item_id"])


def train_target(log: DataFrame, weeks: int = 2, hot: HotKeys | None = None) -> tuple[DataFrame, DataFrame]:
    """(d1, d2): history up to the cut, and the weeks after it for users with history."""
    d1 = before_last_weeks(log, weeks)
    return d1, of_users(last_weeks(log, weeks), d1, hot)


def train_target_holdout(
    log: DataFrame, weeks: int = 2, hot: HotKeys | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(d1, d2, test): first the test weeks are cut off, then the rest is split as above."""
    rest = before_last_weeks(log, HOLDOUT_WEEKS).drop("week_idx")
    d1, d2 = train_target(rest, weeks, hot)
    return d1, d2, of_users(last_weeks(log, HOLDOUT_WEEKS), d1, hot)
