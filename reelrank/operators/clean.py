"""From raw log and catalogue to one row per (user, item) and typed item attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.functions.calendar import calendar_columns, date_layout, read_datetime
from reelrank.functions.text import ids_text, int_list, raw_list, without
from reelrank.operators.skew import HotKeys, hot_keys, number_all, skew_join

# Roles that get a column of their own.
ROLES = ["actor", "producer", "editor", "director", "writer", "composer", "presenter", "commentator"]

# Sums of durations are rounded, so they do not depend on the order in which rows arrive.
DURATION_DIGITS = 6


def total_duration(column: str = "duration") -> Column:
    return F.coalesce(F.round(F.sum(column), DURATION_DIGITS), F.lit(0.0))


def mean_duration(column: str = "duration") -> Column:
    return F.try_divide(F.round(F.sum(column), DURATION_DIGITS), F.count(column))


def _whole_id(column: str) -> Column:
    missing = F.raise_error(F.lit(f"a row of the log has no {column}")).cast("bigint")
    return F.coalesce(F.col(column).cast("bigint"), missing).alias(column)


def typed_log(log: DataFrame) -> DataFrame:
    """Ids as bigint, time from text where it is text, duration as double.

    A missing or bad id raises, and so does a time that no layout fits: such a row would be lost without a word.
    """
    ts = F.col("ts")
    if dict(log.dtypes)["ts"] == "string":
        ts = read_datetime(ts)
    return log.select(
        _whole_id("user_id"),
        _whole_id("item_id"),
        ts.cast("timestamp_ntz").alias("ts"),
        F.col("duration").cast("double").alias("duration"),
    )


def date_layouts(rows: DataFrame, column: str) -> DataFrame:
    """(layout, n): how the dates of a text column are written; nulls and blanks are left out.

    Rows under ``either`` are read month first but could be meant the other way round; where ``day first`` is
    frequent beside them, the column is written day first and such rows need another look.
    """
    return (
        rows.select(date_layout(F.col(column)).alias("layout"))
        .where(F.col("layout").isNotNull())
        .groupBy("layout")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def with_calendar(log: DataFrame) -> DataFrame:
    return log.withColumns(calendar_columns(F.col("ts")))


def dedupe(log: DataFrame) -> DataFrame:
    """One row per (user, item): first watch time and total duration.

    Both aggregates combine map-side, so a pair repeated many times leaves a task as one row.
    """
    return log.groupBy("user_id", "item_id").agg(
        F.min("ts").alias("ts"),
        total_duration().alias("duration"),
    )


def item_views(log: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct viewers of every catalogue item, 0 where nobody watched."""
    views = log.groupBy("item_id").agg(F.countDistinct("user_id").alias("views"))
    return items.select("item_id").join(views, "item_id", "left").na.fill(0, ["views"])


def items_by_views(views: DataFrame, threshold: int = 0) -> DataFrame:
    """Items with more than ``threshold`` viewers."""
    return views.where(F.col("views") > threshold)


def known_items(log: DataFrame, items: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Log rows whose item is in the catalogue."""
    hot = hot_keys(log, ["item_id"]) if hot is None else hot
    return skew_join(log, items.select("item_id"), ["item_id"], "left_semi", hot, ["user_id"])


def user_watch_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


def users_by_watches(log: DataFrame, threshold: int = 0) -> DataFrame:
    """Users with more than ``threshold`` rows."""
    return user_watch_counts(log).where(F.col("n") > threshold)


def keep_active_users(log: DataFrame, threshold: int = 0, hot: HotKeys | None = None) -> DataFrame:
    """Log rows of the users with more than ``threshold`` rows."""
    if threshold <= 0:
        return log
    hot = hot_keys(log, ["user_id"]) if hot is None else hot
    users = users_by_watches(log, threshold).select("user_id")
    return skew_join(log, users, ["user_id"], "left_semi", hot, ["item_id"])


def enrich(log: DataFrame, items: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Genres and countries of the item on every log row; null where the item lists none."""
    hot = hot_keys(log, ["item_id"]) if hot is None else hot
    lists = items.select("item_id", raw_list(F.col("genres")).alias("genres"), raw_list(F.col("countries")).alias("countries"))
    return skew_join(log, lists, ["item_id"], "left", hot, ["user_id"])


def item_genres(items: DataFrame) -> DataFrame:
    """One row per (item, genre)."""
    return items.select("item_id", F.explode(int_list(F.col("genres"))).alias("genre"))


def genre_count(items: DataFrame) -> DataFrame:
    return items.select("item_id", F.coalesce(F.size(int_list(F.col("genres"))), F.lit(0)).alias("len_genres"))


def genre_top3_label(items: DataFrame, top: int = 3) -> DataFrame:
    """The item's genres that are most frequent in the catalogue, joined with a dot."""
    pairs = item_genres(items)
    frequency = pairs.groupBy("genre").agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(pairs, ["genre"])
    ranked = skew_join(pairs.distinct(), frequency, ["genre"], "inner", hot, ["item_id"])
    # An item's list is one catalogue field, so the group is as small as that field.
    label = (
        ranked.groupBy("item_id")
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "genre"))).alias("g"))
        .select("item_id", F.array_join(F.slice(F.col("g.genre").cast("array<string>"), 1, top), ".").alias("label"))
    )
    return items.select("item_id").join(label, "item_id", "left").na.fill("", ["label"])


def staff_by_role(items: DataFrame, people: DataFrame, roles: list[str] = ROLES) -> DataFrame:
    """One id list per role: null where the item has no staff, empty where it has nobody of the role."""
    credits = items.select("item_id", F.explode(F.array_distinct(int_list(F.col("staff")))).alias("id"))
    hot = hot_keys(credits, ["id"])
    matched = skew_join(credits, people.select("id", "role"), ["id"], "inner", hot, ["item_id"])
    lists = matched.groupBy("item_id").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("role") == r, F.col("id")))).alias(r) for r in roles]
    )
    ids = items.select("item_id", int_list(F.col("staff")).alias("staff"))
    none = F.array().cast("array<bigint>")
    return ids.join(lists, "item_id", "left").select(
        "item_id",
        "staff",
        *[F.when(F.size("staff") > 0, F.coalesce(F.col(r), none)).alias(r) for r in roles],
    )


def staff_other_roles(roles: DataFrame) -> DataFrame:
    """Staff that is neither actor nor director, as text."""
    return roles.select("item_id", ids_text(without(F.col("staff"), F.col("actor"), F.col("director"))).alias("staff"))


def staff_text(roles: DataFrame) -> DataFrame:
    """The three people columns of the ranker as text."""
    return roles.select(
        "item_id",
        ids_text(without(F.col("staff"), F.col("actor"), F.col("director"))).alias("staff"),
        ids_text(F.col("director")).alias("director"),
        ids_text(F.col("actor")).alias("actor"),
    )


def dense_ids(keys: DataFrame, column: str, out: str = "dense_id") -> DataFrame:
    """Number the distinct ids from 0 in ascending order, in ranges rather than in one task."""
    return number_all(keys.select(column).distinct(), column, out).withColumn(out, F.col(out) - 1)


def outer_merge(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full join on all columns the two sides share."""
    return left.join(right, [c for c in left.columns if c in right.columns], "full")
