"""Every query by name: ``QUERIES[key](spark, sf_dir)`` over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.functions.calendar import age_in_days, parse_datetime, seconds_of
from reelrank.functions.text import LATIN, clean_text, int_list
from reelrank.operators import analysis, bm25, candidates, clean, coldstart, evaluate, features, similarity, splits, training
from reelrank.operators import ranker as rank
from reelrank.operators.candidates import Budget
from reelrank.operators.skew import HotKeys, exact_quantiles, hot_keys, next_in_order, number_rows
from reelrank.plans import pipeline
from reelrank.plans.oracles import columns
from reelrank.session import materialize, stored_path
from reelrank.sources import testdata
from reelrank.sources import dataset as files
from reelrank.sources.dataset import Dataset, predictions_wide

# Parameters on the small event log, and on the purchases.
E_NEIGHBOURS = 20
E_BUDGET = Budget(20, 20, 0)
P_BUDGET = Budget(100, 100, 4)
# List lengths compared by history length, 900 for one or two watches against 400 for all.
RECALL_BUDGETS = {"by_history": Budget(900, 400, 3), "same": Budget(400, 400, 3)}
H_BUDGET = Budget(60, 30, 40)
E_CONFIG = replace(pipeline.EXPLORATION, budget=E_BUDGET, neighbours=E_NEIGHBOURS, alphabet=LATIN)
ACTIVE_USER = 50
SPLIT_SHARE = 0.8

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _projected(df: DataFrame, key: str) -> DataFrame:
    """The columns of the query in their order, doubles rounded, so results compare exactly."""

    def out(name: str, kind: str) -> Column:
        if kind == "i":
            return F.col(name).cast("bigint").alias(name)
        if kind.startswith("d"):
            return (F.round(F.col(name).cast("double"), int(kind[1:] or 6)) + 0.0).alias(name)
        return F.col(name).cast("timestamp_ntz" if kind == "t" else "string").alias(name)

    return df.select(*[out(n, k) for n, k in columns(key)])


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under its function name, less the ``q_`` of names taken by a library function."""
    key = build.__name__.removeprefix("q_")

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _projected(build(spark, sf_dir), key)

    run.__name__ = key
    QUERIES[key] = run
    return build


# Inputs shared by the queries.


def _e(spark: SparkSession, d: str) -> DataFrame:
    return clean.dedupe(testdata.events_log(spark, d))


def _stored_e(spark: SparkSession, d: str) -> DataFrame:
    """For queries that read the log in several branches."""
    return materialize(_e(spark, d))


def _p(spark: SparkSession, d: str) -> DataFrame:
    """Stored: the steps on purchases read the log several times, and it is a join."""
    return materialize(clean.dedupe(testdata.purchases_log(spark, d)))


def _e_items(spark: SparkSession, d: str) -> DataFrame:
    return testdata.events_log(spark, d).select("item_id").distinct()


def _split(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(d1, d2) of a stored log; d1 is stored as well, candidates read it many times."""
    d1, d2 = splits.train_target(log)
    return materialize(d1.drop("week_idx")), d2.drop("week_idx")


def _durations(spark: SparkSession, d: str) -> DataFrame:
    return features.item_duration_stats(_e(spark, d), _e_items(spark, d))


def _scores(spark: SparkSession, d: str) -> DataFrame:
    return features.scored(_e(spark, d), _durations(spark, d))


def _d1_scores(spark: SparkSession, d: str) -> DataFrame:
    log = _stored_e(spark, d)
    durations = features.item_duration_stats(log, log.select("item_id").distinct())
    return materialize(features.scored(_split(log)[0], durations))


def _roles(spark: SparkSession, d: str) -> DataFrame:
    return clean.staff_by_role(testdata.items(spark, d, people=True), testdata.staff(spark, d))


def _lists(d1: DataFrame, neighbours: int, budget: Budget) -> tuple[DataFrame, DataFrame]:
    """Co-occurrence list and BM25 list; the first stands where the factor model's list would.

    It is stored, so the files of the shuffles that make it are gone before the second list is made.
    """
    follow = materialize(candidates.successor_candidates(d1, candidates.successor_pairs(d1)))
    near = candidates.bm25_candidates(d1, materialize(bm25.item_similarity(d1, neighbours)), budget)
    return follow, near


def _union(d1: DataFrame, neighbours: int = E_NEIGHBOURS, budget: Budget = E_BUDGET) -> DataFrame:
    return candidates.candidate_union(*_lists(d1, neighbours, budget), "cooc")


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    d1, d2 = _split(_stored_e(spark, d))
    return training.labelled(_union(d1), d2, "cooc")


# Scans and cleaning.


@query
def scan_interactions(spark, d):
    return clean.typed_log(testdata.events_log(spark, d))


@query
def parse_mixed_datetime(spark, d):
    items = testdata.items(spark, d, people=True)
    return items.select("item_id", parse_datetime(F.col("date_publication")).alias("published_ts"))


@query
def mixed_layout_datetime(spark, d):
    """Ship dates written in seven layouts, read back: month first wherever a month can stand first."""
    return testdata.dates_as_text(spark, d).withColumn("ts", parse_datetime(F.col("text")))


@query
def date_layouts(spark, d):
    return clean.date_layouts(testdata.dates_as_text(spark, d), "text")


@query
def datetime_features(spark, d):
    return clean.with_calendar(testdata.events_log(spark, d))


@query
def item_release_year(spark, d):
    items = testdata.items(spark, d, people=True)
    return items.select("item_id", F.year(parse_datetime(F.col("year"))).alias("release_year"))


@query
def item_age_days(spark, d):
    items = testdata.items(spark, d, people=True)
    return items.select("item_id", age_in_days(parse_datetime(F.col("date_publication"))).alias("age_days"))


@query
def parse_list_column(spark, d):
    ids = int_list(F.col("genres"))
    return testdata.items(spark, d).select("item_id", F.size(ids).alias("n"), F.array_join(ids, " ").alias("joined"))


@query
def genre_count(spark, d):
    return clean.genre_count(testdata.items(spark, d))


@query
def q_clean_text(spark, d):
    return testdata.items(spark, d, texts=True).select("item_id", clean_text(F.col("description"), LATIN).alias("text"))


@query
def genre_top3_label(spark, d):
    return clean.genre_top3_label(testdata.items(spark, d))


@query
def staff_by_role(spark, d):
    roles = _roles(spark, d)
    return roles.select("item_id", *[F.array_join(r, " ").alias(r) for r in clean.ROLES])


@query
def staff_other_roles(spark, d):
    return clean.staff_other_roles(_roles(spark, d))


@query
def staff_text(spark, d):
    return clean.staff_text(_roles(spark, d))


@query
def dense_item_ids(spark, d):
    views = clean.items_by_views(clean.item_views(_p(spark, d), testdata.items(spark, d)))
    return clean.dense_ids(views, "item_id")


@query
def interactions_dedup(spark, d):
    return clean.with_calendar(_e(spark, d))


@query
def interactions_known_items(spark, d):
    return clean.known_items(_p(spark, d), testdata.catalogue_with_gaps(spark, d))


@query
def interactions_enriched(spark, d):
    rows = clean.enrich(_p(spark, d), testdata.items(spark, d, people=True))
    return rows.withColumns({c: F.array_join(c, "|") for c in ("genres", "countries")})


@query
def outer_merge_common(spark, d):
    log = testdata.events_log(spark, d)

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias(name))

    purchases = _p(spark, d)
    return clean.outer_merge(counted(log, "n_first"), counted(purchases, "n_second"))


@query
def item_views(spark, d):
    return clean.item_views(_e(spark, d), testdata.items(spark, d))


@query
def items_by_views(spark, d):
    return clean.items_by_views(clean.item_views(_e(spark, d), testdata.items(spark, d)))


@query
def users_by_watches(spark, d):
    return clean.users_by_watches(_e(spark, d), ACTIVE_USER)


@query
def user_watch_counts(spark, d):
    return clean.user_watch_counts(_e(spark, d))


# Splits.


@query
def split_train_d1(spark, d):
    return splits.train_target(_e(spark, d))[0]


@query
def split_target_d2(spark, d):
    return splits.train_target(_e(spark, d))[1]


@query
def split_holdout(spark, d):
    parts = splits.train_target_holdout(_p(spark, d))
    named = [df.select("user_id", "item_id", "week_idx", F.lit(n).alias("part")) for df, n in zip(parts, ("d1", "d2", "test"))]
    return named[0].unionByName(named[1]).unionByName(named[2])


# Item features.


@query
def item_duration_stats(spark, d):
    return _durations(spark, d)


@query
def percent_of_watch(spark, d):
    return features.percent_of_watch(_e(spark, d), _durations(spark, d))


@query
def activation_score(spark, d):
    return _scores(spark, d)


@query
def implied_rating(spark, d):
    return _scores(spark, d)


@query
def item_score_stats(spark, d):
    return features.item_score_stats(_d1_scores(spark, d), _e_items(spark, d))


@query
def item_rating_shares(spark, d):
    return features.item_rating_shares(_d1_scores(spark, d), _e_items(spark, d))


@query
def item_trend_slope(spark, d):
    return features.item_trend(_split(_e(spark, d))[0], _e_items(spark, d))


@query
def item_popularity(spark, d):
    return features.item_popularity(_split(_e(spark, d))[0], _e_items(spark, d))


@query
def item_feature_table(spark, d):
    log = _stored_e(spark, d)
    return features.item_feature_table(log, _split(log)[0], log.select("item_id").distinct())


# Histories and candidates.


@query
def user_target_items(spark, d):
    return training.user_target_items(_split(_e(spark, d))[1])


@query
def user_history(spark, d):
    return candidates.user_history(_split(_e(spark, d))[0])


def _by_year(spark: SparkSession, d: str) -> tuple[DataFrame, HotKeys]:
    """Purchases by year, every year hot: cut into ranges of about a fortieth of the log."""
    log = _p(spark, d)
    log = log.select(F.year("ts").alias("year"), seconds_of(F.col("ts")).alias("second"), "user_id", "item_id", "duration")
    return log, hot_keys(log, ["year"], max(1, log.count() // 40))


@query
def yearly_sequence_in_ranges(spark, d):
    """Position and next item of every purchase in its year: the numbering and the successors of long histories."""
    log, hot = _by_year(spark, d)
    numbered = materialize(number_rows(log, ["year"], "second", ["user_id", "item_id"], "position", hot))
    return next_in_order(numbered, "year", "position", [], "item_id", "next_item", hot)


@query
def yearly_quantiles_in_ranges(spark, d):
    """Exact quantiles of the quantity by year, ranked in ranges."""
    log, hot = _by_year(spark, d)
    return exact_quantiles(log, "year", "duration", {"q10": 0.1, "median": 0.5, "q90": 0.9}, hot)


@query
def local_top_items(spark, d):
    return coldstart.local_top_items(_e(spark, d))


@query
def user_favourite_genres(spark, d):
    return coldstart.user_favourite_genres(_p(spark, d), testdata.items(spark, d))


@query
def bm25_item_weights(spark, d):
    return bm25.item_weights(_p(spark, d))


@query
def bm25_item_similarity(spark, d):
    return bm25.item_similarity(_stored_e(spark, d), E_NEIGHBOURS)


@query
def bm25_candidates(spark, d):
    log = _p(spark, d)
    return candidates.bm25_candidates(log, materialize(bm25.item_similarity(log)), P_BUDGET)


@query
def bm25_candidates_by_history(spark, d):
    log = _p(spark, d)
    return candidates.bm25_candidates(log, materialize(bm25.item_similarity(log)), H_BUDGET)


@query
def cooccurrence_pairs(spark, d):
    return candidates.successor_pairs(_stored_e(spark, d))


@query
def cooccurrence_recommend(spark, d):
    log = _stored_e(spark, d)
    return candidates.successor_recommendations(candidates.successor_candidates(log, candidates.successor_pairs(log)))


@query
def candidate_union(spark, d):
    return _union(_split(_stored_e(spark, d))[0])


@query
def candidate_hits(spark, d):
    return training.candidate_hits(_labelled(spark, d))


@query
def candidate_buckets(spark, d):
    return training.candidate_buckets(_labelled(spark, d))


@query
def users_without_hits(spark, d):
    d1, d2 = _split(_p(spark, d))
    rows = training.labelled(_union(d1, bm25.NEIGHBOURS, P_BUDGET), d2, "cooc")
    return training.users_without_hits(d2, training.candidate_hits(rows))


@query
def user_split(spark, d):
    return training.user_split(_e(spark, d), SPLIT_SHARE)


@query
def ranker_training_set(spark, d):
    return training.ranker_training_set(_labelled(spark, d))


@query
def candidate_normalised_scores(spark, d):
    log = _stored_e(spark, d)
    d1, _ = _split(log)
    popularity = features.item_popularity(d1, log.select("item_id").distinct())
    return training.normalised_scores(materialize(_union(d1)), popularity, "cooc")


def _union_and_near(d1: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The stored union of both lists and the stored similarity it came from."""
    sim = materialize(bm25.item_similarity(d1, E_NEIGHBOURS))
    follow = candidates.successor_candidates(d1, candidates.successor_pairs(d1))
    near = candidates.bm25_candidates(d1, sim, E_BUDGET)
    return materialize(candidates.candidate_union(follow, near, "cooc")), sim


@query
def bm25_similarity_stats(spark, d):
    d1, _ = _split(_stored_e(spark, d))
    union, sim = _union_and_near(d1)
    return similarity.bm25_similarity_stats(union, d1, sim)


@query
def bm25_similarity_stats_purchases(spark, d):
    """Full lists and neighbours: 100 candidates of each kind, K = 210."""
    d1, _ = _split(_p(spark, d))
    sim = materialize(bm25.item_similarity(d1))
    near = materialize(candidates.bm25_candidates(d1, sim, P_BUDGET))
    return similarity.bm25_similarity_stats(near, d1, sim)


@query
def factor_similarity_stats(spark, d):
    d1, _ = _split(_stored_e(spark, d))
    return similarity.factor_similarity_stats(materialize(_union(d1)), d1, testdata.factors(spark, d))


@query
def candidate_features(spark, d):
    log = _stored_e(spark, d)
    d1, _ = _split(log)
    items = testdata.items(spark, d, people=True, texts=True)
    union, sim = _union_and_near(d1)
    hot = hot_keys(log, ["item_id"])
    e_items = log.select("item_id").distinct()
    texts = training.item_text_features(
        items,
        clean.staff_text(clean.staff_by_role(items, testdata.staff(spark, d))),
        items.select("item_id", clean_text(F.col("description"), LATIN).alias("text")),
        clean.genre_count(items),
    )
    return training.candidate_features(
        training.normalised_scores(union, features.item_popularity(d1, e_items), "cooc"),
        features.item_feature_table(log, d1, e_items, hot=hot),
        texts,
        [
            similarity.bm25_similarity_stats(union, d1, sim),
            similarity.factor_similarity_stats(union, d1, testdata.factors(spark, d)),
        ],
        "cooc",
        hot=hot_keys(union, ["item_id"]),
    )


# Cold start, recommendations, evaluation.


@query
def cold_start_local(spark, d):
    log = _p(spark, d)
    return coldstart.cold_start_local(log, testdata.items(spark, d), materialize(coldstart.local_top_items(log)))


@query
def cold_start_global(spark, d):
    log, items = _p(spark, d), testdata.items(spark, d)
    views = clean.item_views(log, items)
    return coldstart.cold_start_global(log, items, views, materialize(coldstart.local_top_items(log)))


@query
def recommendations_bm25(spark, d):
    return pipeline.recommend_neighbours(_stored_e(spark, d), testdata.items(spark, d), E_NEIGHBOURS)


@query
def processed_round_trip(spark, d):
    """Log and catalogue with its lists written as the processed CSV tables, and read back."""
    items, path = _e_catalogue(spark, d), stored_path(spark)
    log = testdata.events_log(spark, d)
    files.write_processed(Dataset(log, items, testdata.staff(spark, d)), path)
    read = files.read_processed(spark, path, "logs", log).join(files.read_processed(spark, path, "movies", items), "item_id")
    return read.withColumns({"genres": F.array_join("genres", " "), "n_staff": F.size("staff_ids")})


def _e_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Catalogue with lists as arrays and descriptions of several lines."""
    items = testdata.items(spark, d, people=True, texts=True)
    return items.select("item_id", "name", "description", int_list(F.col("genres")).alias("genres"), int_list(F.col("staff")).alias("staff_ids"))


@query
def predictions_round_trip(spark, d):
    """The lists written as the headerless predictions file, and read back."""
    path = f"{stored_path(spark)}/result"
    files.write_predictions(QUERIES["recommendations_bm25"](spark, d), path)
    return files.read_predictions(spark, path).withColumn("movies", F.array_join("movies", " "))


def _ap(spark: SparkSession, d: str) -> DataFrame:
    d1, d2 = _split(_stored_e(spark, d))
    near = candidates.bm25_candidates(d1, materialize(bm25.item_similarity(d1, E_NEIGHBOURS)), E_BUDGET)
    return evaluate.average_precision(near, d2)


@query
def average_precision_at_k(spark, d):
    return _ap(spark, d)


@query
def map_at_k(spark, d):
    return evaluate.map_at_k(_ap(spark, d))


@query
def candidate_recall_by_history(spark, d):
    """Both budgets side by side, for every length of history."""
    d1, d2 = _split(_p(spark, d))
    sim = materialize(bm25.item_similarity(d1))
    follow = materialize(candidates.successor_candidates(d1, candidates.successor_pairs(d1)))
    # Lists of the longest budget; a shorter one is the start of them.
    longest = max(b.longest for b in RECALL_BUDGETS.values())
    near = materialize(candidates.bm25_candidates(d1, sim, Budget(longest, longest, 0)))
    found = None
    for name, budget in RECALL_BUDGETS.items():
        union = candidates.candidate_union(follow, candidates.cut_to_budget(near, d1, budget), "cooc")
        recall = evaluate.candidate_recall_by_history(union, d1, d2, None).withColumn("budget", F.lit(name))
        found = recall if found is None else found.unionByName(recall)
    return found


@query
def weekly_interactions(spark, d):
    return analysis.weekly_interactions(_e(spark, d))


@query
def users_by_min_history(spark, d):
    return analysis.users_by_min_history(_e(spark, d))


@query
def watch_share_histogram(spark, d):
    return analysis.watch_share_histogram(features.percent_of_watch(_e(spark, d), _durations(spark, d)))


@query
def top_items_weekly_views(spark, d):
    log = _p(spark, d)
    return analysis.top_items_weekly_views(log, clean.item_views(log, testdata.items(spark, d)), week=14)


# Fitted models: rows-only.


@query
def als_candidates(spark, d):
    log = _stored_e(spark, d)
    return candidates.als_candidates(log, candidates.fit_als(log, max_iter=E_CONFIG.als_iterations), E_BUDGET)


def _events_dataset(spark: SparkSession, d: str) -> Dataset:
    items = testdata.items(spark, d, people=True, texts=True)
    return Dataset(testdata.events_log(spark, d), items, testdata.staff(spark, d))


# The four queries below ask for one and the same training, which takes minutes. Its tables are stored; they are
# taken again while the application and the input files (their sizes and times) are the same.
_STATE: dict[tuple, tuple[pipeline.Prepared, pipeline.Trained, DataFrame]] = {}


def _inputs(spark: SparkSession, data: Dataset) -> tuple:
    """Name, size and time of every file that the training reads."""
    out = []
    for name in sorted({f for df in (data.log, data.items, data.staff) for f in df.inputFiles()}):
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        out.append((name, status.getLen(), status.getModificationTime()))
    return tuple(out)


def _trained(spark: SparkSession, d: str) -> tuple[pipeline.Prepared, pipeline.Trained, DataFrame]:
    """Prepared tables, fitted ranker, and the stored score of every candidate."""
    data = _events_dataset(spark, d)
    key = (spark.sparkContext.applicationId, E_CONFIG, _inputs(spark, data))
    if key not in _STATE:
        prepared = pipeline.prepare(data, E_CONFIG)
        trained = pipeline.train(prepared, E_CONFIG)
        _STATE[key] = (prepared, trained, materialize(pipeline.scores(prepared, trained, E_CONFIG)))
    return _STATE[key]


def _recommended(spark: SparkSession, d: str) -> DataFrame:
    prepared, _, scores = _trained(spark, d)
    return pipeline.lists_from(prepared, scores, E_CONFIG)


@query
def ranker_scores(spark, d):
    return _trained(spark, d)[2]


@query
def top20_per_user(spark, d):
    return rank.top_per_user(_trained(spark, d)[2])


@query
def recommendations(spark, d):
    return _recommended(spark, d)


@query
def q_predictions_wide(spark, d):
    return predictions_wide(_recommended(spark, d)).withColumn("movies", F.array_join("movies", " "))
