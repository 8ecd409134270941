"""Joins, numberings and quantiles that hold when one key owns a third of all rows.

A *hot* key is one with more than ``hot_rows`` rows. All of them are kept, as a table: by counting it has at
most rows / hot_rows entries. A hot key is cut into pieces of about ``hot_rows`` rows. Nothing is dropped:
a key that is not hot just takes the ordinary path, and both paths give the same rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelrank.session import materialize

HOT_ROWS = 1_000_000


@dataclass(frozen=True)
class HotKeys:
    """The hot keys of a table: ``table`` (key..., _n) or None where there are none; ``largest`` of the _n."""

    keys: tuple[str, ...]
    table: DataFrame | None
    hot_rows: int
    largest: int = 0

    def __bool__(self) -> bool:
        return self.table is not None

    def renamed(self, *keys: str) -> HotKeys:
        """The same keys for a table that holds them under other names."""
        table = self.table and self.table.toDF(*keys, "_n")
        return HotKeys(keys, table, self.hot_rows, self.largest)

    def frame(self) -> DataFrame:
        """The keys with the number of pieces each is cut into."""
        pieces = F.ceil(F.col("_n") / self.hot_rows).cast("int") + 1
        return self.table.select(*self.keys, pieces.alias("_pieces"))


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> HotKeys:
    """Measure the hot keys of ``df``: one map-side combined count, one number fetched."""
    found = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows)
    largest = found.agg(F.max("_n")).first()[0]
    if largest is None:
        return HotKeys(tuple(keys), None, hot_rows)
    return HotKeys(tuple(keys), materialize(found), hot_rows, largest)


def skew_join(
    big: DataFrame, small: DataFrame, keys: list[str], how: str, hot: HotKeys, spread: list[str], parts: int | None = None
) -> DataFrame:
    """``big`` joined to ``small`` with the hot keys of ``big`` cut into pieces.

    Rows of a hot key go to pieces by a hash of the ``spread`` columns; the matching rows of
    ``small`` are repeated once per piece. Right for inner, left, left_semi and left_anti. The
    keys of ``hot`` may be some of the join keys only: a join key has no more rows than its part.
    ``parts`` is the number of tasks, for a join that makes many rows of few.
    """

    def dealt(rows: DataFrame, by: list[str]) -> DataFrame:
        return rows.repartition(parts, *by) if parts else rows

    if not hot:
        return dealt(big, keys).join(dealt(small, keys), keys, how)
    pieces = hot.frame()
    on = list(hot.keys)
    left = big.join(pieces, on, "left").withColumn(
        "_piece",
        F.when(F.col("_pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64(*spread), F.col("_pieces")).cast("int")),
    )
    right = small.join(pieces, on, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    )
    by = keys + ["_piece"]
    return dealt(left.drop("_pieces"), by).join(dealt(right.drop("_pieces"), by), by, how).drop("_piece")


def range_pieces(df: DataFrame, keys: list[str], order: list[str], hot: HotKeys) -> DataFrame:
    """Add ``_piece``: rows of the hot keys are dealt out in ranges of (keys, order), about ``hot_rows`` to a range.

    The shuffle looks the range of a row up by binary search; pieces ascend with ``order`` within a key, and rows equal in
    keys and order share one. Stored, since the pieces must stand. Where the ranges end decides only the size of the pieces,
    never a result. All other rows are piece 0. The keys of ``hot`` may be some of ``keys``.
    """
    if not hot:
        return df.withColumn("_piece", F.lit(0))
    on = list(hot.keys)
    rows = hot.table.agg(F.sum("_n")).first()[0]
    parts = math.ceil(rows / hot.hot_rows) + 1
    dealt = df.join(hot.table.select(*on), on, "left_semi").repartitionByRange(parts, *keys, *order)
    dealt = materialize(dealt.withColumn("_piece", F.spark_partition_id()))
    ordinary = df.join(hot.table.select(*on), on, "left_anti").withColumn("_piece", F.lit(0))
    return ordinary.unionByName(dealt.select(*df.columns, "_piece"))


def piece_offsets(pieces: DataFrame, keys: list[str], hot: HotKeys, weight: Column) -> DataFrame:
    """Total ``weight`` in the earlier pieces of the same hot key: a row per piece of a hot key."""
    sizes = (
        pieces.join(hot.table.select(*hot.keys), list(hot.keys), "left_semi")
        .groupBy(*keys, "_piece")
        .agg(F.sum(weight).alias("_size"))
    )
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(*keys, "_piece", F.sum("_size").over(earlier).alias("_offset"))


def number_rows(
    df: DataFrame, keys: list[str], order: str, ties: list[str], out: str, hot: HotKeys | None = None
) -> DataFrame:
    """Number the rows of each key from 1 by (order, ties), ascending.

    The same numbers as ``row_number`` over the key, without a task that holds a whole hot key.
    """
    if hot is None:
        hot = hot_keys(df, keys)
    cut = range_pieces(df, keys, [order, *ties], hot)
    within = Window.partitionBy(*keys, "_piece").orderBy(order, *ties)
    numbered = cut.withColumn(out, F.row_number().over(within).cast("bigint"))
    if hot:
        offsets = piece_offsets(cut, keys, hot, F.lit(1))
        numbered = numbered.join(offsets, [*keys, "_piece"], "left").withColumn(
            out, F.col(out) + F.coalesce("_offset", F.lit(0))
        )
    return numbered.select(*df.columns, out)


def number_all(df: DataFrame, order: str, out: str) -> DataFrame:
    """Number all rows from 1 by the unique column ``order``, in ranges."""
    return number_rows(df.withColumn("_all", F.lit(0)), ["_all"], order, [], out).drop("_all")


def next_in_order(
    df: DataFrame, key: str, order: str, ties: list[str], value: str, out: str, hot: HotKeys | None = None
) -> DataFrame:
    """The ``value`` of the following row of the same key by (order, ties); null on the last row."""
    if hot is None:
        hot = hot_keys(df, [key])
    cut = range_pieces(df, [key], [order, *ties], hot)
    within = Window.partitionBy(key, "_piece").orderBy(order, *ties)
    stepped = cut.withColumn(out, F.lead(value).over(within))
    if hot:
        # The last row of a piece continues with the first row of the next piece of its key.
        firsts = (
            cut.join(hot.table.select(key), key, "left_semi")
            .groupBy(key, "_piece")
            .agg(F.min(F.struct(order, *ties, value)).alias("_first"))
        )
        later = Window.partitionBy(key).orderBy("_piece")
        firsts = firsts.select(key, "_piece", F.lead(f"_first.{value}").over(later).alias("_next"))
        stepped = stepped.join(firsts, [key, "_piece"], "left").withColumn(out, F.coalesce(out, "_next"))
    return stepped.select(*df.columns, out)


def exact_quantiles(
    df: DataFrame, key: str, value: str, probabilities: dict[str, float], hot: HotKeys | None = None
) -> DataFrame:
    """Exact quantiles per key with linear interpolation, one column per entry of ``probabilities``.

    Equal values are counted map-side first, then a running count finds the two neighbours of
    each position. A sort that spills replaces the in-memory value map of ``percentile``, and a
    hot key is ranked in ranges. Nulls are left out.
    """
    present = df.where(F.col(value).isNotNull()).select(key, value)
    if hot is None:
        hot = hot_keys(present, [key])
    counted = range_pieces(present, [key], [value], hot).groupBy(key, "_piece", value).agg(F.count(F.lit(1)).alias("_c"))
    running = Window.partitionBy(key, "_piece").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_upto", F.sum("_c").over(running))
    if hot:
        offsets = piece_offsets(counted, [key], hot, F.col("_c"))
        ranked = ranked.join(offsets, [key, "_piece"], "left").withColumn(
            "_upto", F.col("_upto") + F.coalesce("_offset", F.lit(0))
        )
    totals = counted.groupBy(key).agg(F.sum("_c").alias("_n"))
    placed = skew_join(ranked, totals, [key], "inner", hot, [value])

    def at(position: Column) -> Column:
        return F.min(F.when(F.col("_upto") > position, F.col(value)))

    parts = []
    for name, p in probabilities.items():
        position = F.lit(float(p)) * (F.col("_n") - 1)
        parts += [
            at(F.floor(position)).alias(f"_{name}_lo"),
            at(F.ceil(position)).alias(f"_{name}_hi"),
        ]
    found = placed.groupBy(key, "_n").agg(*parts)

    def interpolated(name: str, p: float) -> Column:
        position = F.lit(float(p)) * (F.col("_n") - 1)
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        return low + (high - low) * (position - F.floor(position))

    return found.select(key, *[interpolated(n, p).alias(n) for n, p in probabilities.items()])


__all__ = [
    "HotKeys",
    "exact_quantiles",
    "hot_keys",
    "next_in_order",
    "number_all",
    "number_rows",
    "piece_offsets",
    "range_pieces",
    "skew_join",
]
