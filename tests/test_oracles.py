"""Every query with an oracle gives the rows of its SQL on the same parquet tables."""

import pytest

import __spark_entry__ as entry
import check
from reelrank.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return check.connect(sf_dir)


# Pairs of tables without an equality, and rows handed to Python one operator at a time.
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def look_at_plan(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = [name for name in UNWANTED if name in plan]
    assert not found, f"{found} in {plan}"
    # A window without a key sorts everything in one task; only rows of a bounded list may meet there.
    assert "SinglePartition" not in plan or "HashAggregate" in plan or "TakeOrdered" in plan


@pytest.mark.parametrize("key", list(ORACLES))
def test_matches_oracle(spark, sf_dir, connection, key):
    verdict, _ = check.compare(spark, connection, sf_dir, key, look_at_plan)
    assert verdict == "match"


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "rank", "item_id", "source"]
    assert df.count() > 0
