"""The hot paths give the same rows as the plain operators; hot keys are provoked by a low limit."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelrank.operators import skew


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    # Key 1 owns a third of the rows.
    return [
        (1 if i % 3 == 0 else rng.randrange(2, 30), rng.randrange(0, 60), float(rng.randrange(0, 40)), i)
        for i in range(1500)
    ]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "k bigint, o bigint, v double, id bigint").repartition(5).persist()


def hot(table, keys, limit=100):
    found = skew.hot_keys(table, keys, limit)
    assert found
    return found


def test_hot_keys_are_the_heaviest(table):
    assert [r[0] for r in hot(table, ["k"]).table.collect()] == [1]
    assert not skew.hot_keys(table, ["k"], 10_000)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join(spark, table, how):
    small = spark.createDataFrame([(k, s) for k in (1, 2, 3, 99) for s in ("a", "b")], "k bigint, s string")
    got = skew.skew_join(table, small, ["k"], how, hot(table, ["k"]), ["id"])
    want = table.join(small, ["k"], how)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_skew_join_on_part_of_the_keys(spark, table):
    small = spark.createDataFrame([(k, o) for k in (1, 2) for o in range(30)], "k bigint, o bigint")
    got = skew.skew_join(table, small, ["k", "o"], "inner", hot(table, ["k"]), ["id"])
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in table.join(small, ["k", "o"]).collect())


def test_number_rows(table, rows):
    got = skew.number_rows(table, ["k"], "o", ["id"], "n", hot(table, ["k"])).collect()
    want = {}
    groups = defaultdict(list)
    for k, o, _, i in rows:
        groups[k].append((o, i))
    for members in groups.values():
        want.update({i: n for n, (_, i) in enumerate(sorted(members), 1)})
    assert {r.id: r.n for r in got} == want


def test_number_all(spark, monkeypatch):
    ids = spark.createDataFrame([(i * i,) for i in range(500)], "x bigint").repartition(4)
    monkeypatch.setattr(skew, "hot_keys", lambda df, keys, hot_rows=50, real=skew.hot_keys: real(df, keys, 50))
    got = skew.number_all(ids, "x", "n").collect()
    assert sorted((r.x, r.n) for r in got) == [(i * i, i + 1) for i in range(500)]


def test_next_in_order(table, rows):
    got = skew.next_in_order(table, "k", "o", ["id"], "v", "nxt", hot(table, ["k"])).collect()
    groups = defaultdict(list)
    for k, o, v, i in rows:
        groups[k].append((o, i, v))
    want = {}
    for members in groups.values():
        members.sort()
        for here, there in zip(members, [*members[1:], None]):
            want[here[1]] = there[2] if there else None
    assert {r.id: r.nxt for r in got} == want


@pytest.mark.parametrize("limit", [100, 10_000])
def test_exact_quantiles(table, rows, limit):
    wanted = {"q1": 0.25, "q5": 0.5, "q9": 0.9}
    got = skew.exact_quantiles(table, "k", "v", wanted, skew.hot_keys(table, ["k"], limit)).collect()
    groups = defaultdict(list)
    for k, _, v, _ in rows:
        groups[k].append(v)
    assert len(got) == len(groups)
    for row in got:
        for name, p in wanted.items():
            assert row[name] == pytest.approx(float(np.quantile(groups[row.k], p)))


def test_quantile_fixture(spark):
    df = spark.createDataFrame([(0, v) for v in (1.0, 2.0, 4.0, 10.0, None)], "k bigint, v double")
    row = skew.exact_quantiles(df, "k", "v", {"a": 0.9, "m": 0.5}).first()
    assert (row.a, row.m) == (pytest.approx(8.2), 3.0)
    spread = df.agg(F.stddev_samp("v").alias("s"), F.stddev_pop("v").alias("p")).first()
    assert (spread.s, spread.p) == (pytest.approx(4.031129, abs=1e-6), pytest.approx(3.491060, abs=1e-6))


def test_ranges_are_looked_up_in_the_shuffle(spark, table):
    """No list of cuts on the rows; a key of equal order values is cut by the ties."""
    numbered = skew.number_rows(table, ["k"], "o", ["id"], "n", hot(table, ["k"]))
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan and "cuts" not in plan
    flat = spark.range(900).select(F.lit(1).alias("k"), F.lit(5).alias("o"), "id")
    found = skew.hot_keys(flat, ["k"], 100)
    pieces = skew.range_pieces(flat, ["k"], ["o", "id"], found).groupBy("_piece").count().collect()
    assert len(pieces) >= 9 and max(r["count"] for r in pieces) <= 300
    numbered = skew.number_rows(flat, ["k"], "o", ["id"], "n", found)
    assert all(r.n == r.id + 1 for r in numbered.collect())


def test_text_orders(spark):
    words = spark.createDataFrame([(1, f"w{i:03}") for i in range(300)], "k long, o string")
    got = skew.number_rows(words, ["k"], "o", [], "n", skew.hot_keys(words, ["k"], 50))
    assert all(r.o == f"w{r.n - 1:03}" for r in got.collect())
