"""The trained pipeline end to end on the event log, and the shape of the plans."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from reelrank.operators import candidates, evaluate, ranker
from reelrank.plans import pipeline, registry
from reelrank.sources import testdata

@pytest.fixture(autouse=True, scope="module")
def few_rounds():
    """The registered queries train in full; the shape of their results needs fewer rounds."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(registry, "E_CONFIG", replace(registry.E_CONFIG, rounds=10, als_iterations=5))
        yield


FULL = registry.E_CONFIG


def test_registered_queries_train_in_full():
    assert (FULL.rounds, FULL.als_iterations) == (ranker.ROUNDS, pipeline.PRODUCTION.als_iterations) == (500, 15)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    """Parquet folders and files that the plan of ``df`` reads."""
    return set(df.inputFiles())


def test_no_step_reads_the_raw_log_again(spark, sf_dir):
    data = registry._events_dataset(spark, sf_dir)
    raw = scans(data.log)
    prepared = pipeline.prepare(data, registry.E_CONFIG)
    stage = pipeline.first_stage(prepared.log, replace(registry.E_CONFIG, als_iterations=1))
    table = pipeline.features_for(stage.union, stage, prepared, prepared.log, registry.E_CONFIG)
    scored = stage.union.select("user_id", "item_id", F.lit(0.5).alias("score"))
    lists = pipeline.lists_from(prepared, scored, registry.E_CONFIG)
    for name, frame in {"log": prepared.log, "items": prepared.items, "features": table, "lists": lists}.items():
        assert not raw & scans(frame), name


def test_both_cold_starts(spark, sf_dir):
    prepared = pipeline.prepare(registry._events_dataset(spark, sf_dir), registry.E_CONFIG)
    none = spark.createDataFrame([], "user_id bigint, item_id bigint, score double")
    local, everywhere = (
        {tuple(r) for r in pipeline.lists_from(prepared, none, replace(registry.E_CONFIG, cold_start=c)).collect()}
        for c in ("local", "global")
    )
    assert local and everywhere and local != everywhere


def test_scan_reads_only_its_columns(spark, sf_dir):
    query = entry.queries()["user_favourite_genres"](spark, sf_dir)
    assert "p_retailprice" not in plan_of(query) and "p_type" not in plan_of(query) and "l_comment" not in plan_of(query)


def test_stored_tables_can_be_removed(spark):
    from reelrank import session

    kept = session.materialize(spark.range(3))
    (path,) = {p.rpartition("/")[0] for p in kept.inputFiles()}
    session.discard_stored(spark)
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def test_recommendations(spark, sf_dir):
    got = entry.queries()["recommendations"](spark, sf_dir).persist()
    log = testdata.events_log(spark, sf_dir).select("user_id", "item_id").distinct()
    assert got.join(log, ["user_id", "item_id"]).count() == 0
    assert got.groupBy("user_id", "item_id").count().where("count > 1").count() == 0
    assert got.groupBy("user_id", "rank").count().where("count > 1").count() == 0
    assert got.agg(F.max("rank")).first()[0] <= 20
    assert got.select("user_id").distinct().count() == log.select("user_id").distinct().count()
    wide = entry.queries()["predictions_wide"](spark, sf_dir)
    assert wide.agg(F.sum(F.size(F.split("movies", " ")))).first()[0] == got.count()


def test_trained_lists_by_value(spark, sf_dir):
    """Scores, lists and routing against plain window SQL over the stored tables."""
    prepared, trained, scores = registry._trained(spark, sf_dir)
    scores.createOrReplaceTempView("trained_scores")
    want = spark.sql("""SELECT * FROM (SELECT user_id, item_id, score,
        row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank FROM trained_scores) WHERE rank <= 20""")
    got = entry.queries()["top20_per_user"](spark, sf_dir)
    rows = lambda df: {(r.user_id, r.rank, r.item_id) for r in df.collect()}
    assert rows(got) == rows(want)
    lists = entry.queries()["recommendations"](spark, sf_dir).collect()
    ranked = {(r.user_id, r.rank, r.item_id) for r in lists if r.source == "ranked"}
    assert ranked == rows(want)  # a ranked item keeps its place, popular items follow
    served = {r.user_id for r in scores.select("user_id").distinct().collect()}
    unserved = {r.user_id for r in trained.without_hits.collect()}
    assert not served & unserved
    assert {r.user_id for r in lists if r.source == "cold_start"} >= unserved - served


def test_map_of_ranker_beside_neighbours(spark, sf_dir):
    """Ranked order against the neighbours' own order on the weeks the ranker learnt from: no worse there."""
    prepared, trained, scores = registry._trained(spark, sf_dir)
    d1, d2 = registry.splits.train_target(prepared.log)
    d1 = pipeline.materialize(d1.drop("week_idx"))
    near = candidates.bm25_candidates(d1, pipeline.materialize(registry.bm25.item_similarity(d1, 20)), registry.E_BUDGET)
    stage = pipeline.first_stage(d1, registry.E_CONFIG)
    table = pipeline.features_for(stage.union, stage, prepared, d1, registry.E_CONFIG)
    ranked = ranker.top_per_user(ranker.ranker_scores(trained.ranker, table))
    score = lambda lists: evaluate.map_at_k(evaluate.average_precision(lists, d2)).first()["map"]
    assert score(ranked) >= score(near)


def test_scores_are_probabilities(spark, sf_dir):
    low, high = entry.queries()["ranker_scores"](spark, sf_dir).agg(F.min("score"), F.max("score")).first()
    assert 0 <= low < high <= 1


def test_offline_test(spark, sf_dir):
    """Purchases span years, so weeks for training remain after the test weeks are cut off."""
    items = testdata.items(spark, sf_dir, people=True, texts=True)
    data = pipeline.Dataset(testdata.purchases_log(spark, sf_dir), items, testdata.staff(spark, sf_dir))
    config = replace(registry.E_CONFIG, rounds=2, als_iterations=2, weeks_for_ranker=20)
    row = pipeline.offline_test(data, config).first()
    assert 0 <= row["map"] <= 1 and row.n_users > 0


def test_profiles():
    assert (pipeline.PRODUCTION.budget.few, pipeline.PRODUCTION.budget.many) == (800, 400)
    assert (pipeline.EXPLORATION.budget.few, pipeline.EXPLORATION.budget.threshold) == (100, 4)
