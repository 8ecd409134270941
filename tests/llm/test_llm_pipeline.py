import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from reelrank.llm import decontaminate, quality, simhash
from reelrank.session import materialize
from test_llm_line_dedup import brute as brute_lines
from test_llm_simhash import brute as brute_groups


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """(name, what went in, what came out) of every stage."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        made = materialize(stage(spark, docs, sf_dir))
        out.append((name, docs, made))
        docs = made
    return {name: (before, after) for name, before, after in out}


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_stay(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns, name


def test_quality(spark, sf_dir, stages):
    before, after = stages["quality"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    trees = quality.fit(before, labels.where(~quality.held_out(F.col("doc_id"))))
    want = {d for d, t in rows(before).items() if trees.score(quality._matrix([t]))[0] >= 0.3}
    assert set(rows(after)) == want and 0 < len(want) < before.count()


def test_lines(stages):
    before, after = stages["line_dedup"]
    assert rows(after) == brute_lines(sorted(rows(before).items()))[0]
    assert after.where(F.length("text") != F.col("n_chars")).count() == 0


def test_near_duplicates(stages):
    before, after = stages["near_dedup"]
    prints = [(d, simhash.fingerprint(t, simhash.WIDTH)) for d, t in sorted(rows(before).items())]
    assert set(rows(after)) == set(brute_groups(prints, simhash.BITS))


def test_decontaminated(spark, sf_dir, stages):
    before, after = stages["decontaminate"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    words = [dc for _, t in items if (dc := decontaminate.words_of(t))]

    def dirty(text):
        own = decontaminate.words_of(text)
        return any(decontaminate.least_distance(w, own) <= decontaminate.budget_of(w) for w in words)

    assert set(rows(after)) == {d for d, t in rows(before).items() if not dirty(t)}


def test_packed(stages):
    before, after = stages["packing"]
    assert {r["doc_id"] for r in after.select("doc_id").collect()} == set(rows(before))
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_run_is_the_stages(spark, sf_dir, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(map(tuple, stages["packing"][1].collect()))


def test_stages_survive_odd_rows(spark, make_docs, odd_rows, sf_dir):
    docs = make_docs(odd_rows, clashing=False).withColumns({"n_chars": F.length("text").cast("long"), "score": F.lit("own"), "fp": F.lit("own")})
    for name, stage in corpus_pipeline.STAGES:
        made = materialize(stage(spark, docs, sf_dir))
        if name != "packing":
            assert made.columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name
        docs = made if name != "quality" else docs


