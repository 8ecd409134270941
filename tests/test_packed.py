"""Packed neighbours and the lists made from them against the rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelrank.operators import bm25, candidates, gram, packed
from reelrank.operators.candidates import Budget
from reelrank.plans import registry
from reelrank.session import materialize, view_source

K = 7


@pytest.fixture(scope="module")
def log(spark):
    """60 users, one without an id; users 0 and 1 saw nearly everything, and one row has no item."""
    rng = np.random.default_rng(3)
    seen = rng.random((60, 25)) < 0.2
    seen[0] = True
    seen[1] = rng.random(25) < 0.8
    seen[:, 0] |= rng.random(60) < 0.5
    users, items = np.nonzero(seen)
    rows = spark.createDataFrame(pd.DataFrame({"user_id": users.astype("int64"), "item_id": items.astype("int64") * 3}))
    unnamed = rows.where("user_id = 7").select(F.lit(None).cast("bigint").alias("user_id"), "item_id")
    no_item = rows.where("user_id = 8").limit(1).select("user_id", F.lit(None).cast("bigint").alias("item_id"))
    return materialize(rows.unionByName(unnamed).unionByName(no_item))


@pytest.fixture(scope="module")
def sim(log):
    return materialize(bm25.item_similarity(log, K))


def rows_of(df):
    return sorted(map(str, df.collect()))


# One block; many blocks of targets; a few products at a time, single items above that; many blocks of source items.
OPTIONS = [{}, {"held": 40}, {"sizes": gram.Sizes(at_once=14)}, {"held_log": 300, "held": 60}]


@pytest.mark.parametrize("options", OPTIONS)
def test_packed_neighbours_are_the_rows(log, sim, options):
    view = bm25.item_similarity(log, K, packed_rows=0, **options)
    assert isinstance(view_source(view), packed.Packed) and materialize(view) is view
    assert rows_of(view) == rows_of(sim)


@pytest.mark.parametrize("options", [{}, {"list_places": 30, "products": 5, "groups": 2}])
def test_lists_from_packed_neighbours(log, sim, options):
    held = view_source(bm25.item_similarity(log, K, packed_rows=0, held=40))
    want = candidates.bm25_candidates(log, sim, Budget(5, 5, 0))
    assert rows_of(packed.ranked_lists(log, held, 5, **options)) == rows_of(want)
    # A log that is another table with the same rows is numbered again.
    assert rows_of(packed.ranked_lists(materialize(log), held, 5, **options)) == rows_of(want)


def test_lists_are_not_shuffled(log):
    """Neither similarities nor lists are sent: the plan reads stored tables task by task."""
    lists = candidates.bm25_candidates(log, materialize(bm25.item_similarity(log, K, packed_rows=0)), Budget(5, 5, 0))
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Exchange" not in plan and "Sort" not in plan


def test_many_equal_scores_go_to_the_lower_item(spark):
    """Every item has the same users: all scores of a user tie, in every block, also where a list is cut many times."""
    rows = [(u, i) for u in range(3) for i in range(100, 160) if u or i < 102]
    log = materialize(spark.createDataFrame([*rows, *[(9, 500 + u) for u in range(4)]], "user_id long, item_id long"))
    held = view_source(bm25.item_similarity(log, 60, packed_rows=0, held=200))
    got = packed.ranked_lists(log, held, 10).where("user_id = 0").orderBy("rank").collect()
    assert [(r.item_id, r["rank"]) for r in got] == [(102 + k, k + 1) for k in range(10)]


def test_ids_with_more_digits_than_a_double(log):
    """Also beside a row without an item."""
    long = materialize(log.where("user_id is not null").withColumn("item_id", F.col("item_id") + F.lit(1 << 60)))
    view, rows = bm25.item_similarity(long, K, packed_rows=0), materialize(bm25.item_similarity(long, K))
    assert rows_of(view) == rows_of(rows)
    lists = [candidates.bm25_candidates(long, s, Budget(5, 5, 0)) for s in (view, rows)]
    assert rows_of(lists[0]) == rows_of(lists[1])


def test_a_hub_keeps_the_rows(log, sim):
    """An item whose users' histories are more than a task may hold is shared out by the other way."""
    rows = bm25.item_similarity(log, K, packed_rows=0, held_log=3)
    assert view_source(rows) is None and rows_of(rows) == rows_of(sim)


def test_rounding_is_that_of_the_lists(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.random(200) * 50, np.round(rng.random(200), 8) + 5e-10, [0.0, 1e-9, 1.5e-9, 2.5e-9, 1.0000000005, 3e7]])
    got = [r[0] for r in spark.createDataFrame([(float(v),) for v in values], "v double").select(F.round("v", 9)).collect()]
    assert packed.rounded(values).tolist() == got


def test_best_of_ragged_rows():
    rng = np.random.default_rng(2)
    row = np.sort(rng.integers(0, 40, 900))
    row[row == 7] = 8
    value = rng.integers(0, 30, 900).astype(float)
    kept, bar = packed.at_least_nth(row, value, 40, 5)
    entry, rank = packed.first_n(row, value, 40, 5)
    want = [(i, k) for r in range(40) for k, i in enumerate(sorted(np.flatnonzero(row == r), key=lambda i: (-value[i], i))[:5], 1)]
    assert list(zip(entry, rank)) == want and kept[entry].all() and bar[7] == -np.inf
    assert all(kept[i] == (value[i] >= bar[row[i]]) for i in range(900))


def test_lists_by_history_from_packed_neighbours(log, sim):
    """The length goes by all rows of a user, also those without an item; who has no id has no list."""
    budget = Budget(6, 3, 6)
    lists = candidates.bm25_candidates(log, materialize(bm25.item_similarity(log, K, packed_rows=0)), budget)
    want = candidates.bm25_candidates(log, sim, budget)
    assert rows_of(lists) == rows_of(want)
    lengths = {r["count"] for r in lists.groupBy("user_id").count().collect()}
    assert {3, 6} <= lengths and lists.where("user_id is null").count() == 0


def test_the_first_list_is_stored_before_the_second_is_made(spark):
    """Its shuffles would lie on disk beside those of the union until the query ends."""
    rows = [(u, (u * 3 + 5 * k) % 23, k) for u in range(12) for k in range(6)]
    d1 = materialize(spark.createDataFrame(rows, "user_id long, item_id long, k long").selectExpr("user_id", "item_id", "timestamp_seconds(k) as ts"))
    follow, near = registry._lists(d1, K, Budget(5, 5, 0))
    assert "Exchange" not in follow._jdf.queryExecution().executedPlan().toString()
    whole = candidates.successor_candidates(d1, candidates.successor_pairs(d1))
    assert follow.count() > 0 and rows_of(follow) == rows_of(whole) and near.count() > 0
