"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with underscores put before it where ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Rows that a Python worker is sent at once; documents may be long.
ARROW_ROWS = "512"


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, its session set to hand rows to Python in batches that long texts keep small enough."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return df


def blocks(rows: int, size: int) -> int:
    """Number of blocks of about ``size`` rows; one at least."""
    return max(1, -(-rows // size))


def sha256_of(parts: Column, separator: str = "") -> Column:
    """Lowercase hex digest of an array of strings, joined."""
    return F.sha2(F.array_join(parts, separator), 256)


#: Elements of an array that one step of an aggregation appends to.
STRIDE = 256


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` made once per row, however often and however deep inside it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_sums(lengths: Column) -> Column:
    """Sums of the elements before each, in blocks, so the work stays far below the square."""

    def sums(values: Column, start: Column) -> Column:
        begin = F.struct(start.cast("long").alias("t"), F.array().cast("array<bigint>").alias("a"))
        step = lambda acc, x: F.struct((acc["t"] + x).alias("t"), F.concat(acc["a"], F.array(acc["t"])).alias("a"))
        return F.aggregate(values, begin, step, lambda acc: acc["a"])

    def in_blocks(values: Column) -> Column:
        last = F.greatest(F.lit(0), F.floor((F.size(values) - 1) / STRIDE).cast("int"))
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * STRIDE + 1, STRIDE))

    def summed(cut: Column) -> Column:
        totals = F.transform(cut, lambda b: F.aggregate(b, F.lit(0).cast("long"), lambda t, x: t + x))
        return F.flatten(F.zip_with(cut, sums(totals, F.lit(0)), sums))

    return bound(lengths, lambda values: bound(in_blocks(values), summed))


#: A side of so many values at most is sent to all executors; a larger one is shuffled. The rows are the same.
SENT = 2_000_000


def sent(df: DataFrame, values: int) -> DataFrame:
    """``df`` marked to be sent to all executors if its measured number of values allows."""
    return F.broadcast(df) if values <= SENT else df
