import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelrank.llm import quality, queries


def test_trees_learn_and_arrays_agree_with_walking():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    trees = quality.grow(x[:2000], y[:2000])
    score = trees.score(x[2000:])
    assert ((score >= 0.5) == y[2000:]).mean() > 0.95
    for row, s in zip(x[2000:2050], score):
        margin = trees.base
        for f, c, leaf in zip(trees.feature, trees.cut, trees.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + int(row[f[node]] > c[node])
            margin += leaf[node - len(f)]
        assert s == pytest.approx(1 / (1 + np.exp(-margin)))


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = queries.op5_quality(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    good = [r["score"] for r in held if labels[r["doc_id"]] == 1]
    bad = [r["score"] for r in held if labels[r["doc_id"]] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) > 0.9


def test_odd_rows_and_labels(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows)
    labels = spark.createDataFrame(
        [(4, 1, 0), (4, 0, 0), (5, 1, 0), (6, None, 0), (None, 1, 0), (77, 1, 0)], "doc_id long, quality int, x int"
    )
    trees = quality.fit(docs, labels)
    scored = docs.withColumn("s", quality.scorer(trees)(F.col("text"))).collect()
    assert len(scored) == len(odd_rows) and all(0 <= r["s"] <= 1 for r in scored)
    one_class = quality.fit(docs, labels.where("doc_id = 5"))
    assert one_class.score(np.zeros((1, 1)))[0] == pytest.approx(2 / 3)
    assert quality.fit(docs, labels.limit(0)).score(np.zeros((2, 1))).tolist() == [0.5, 0.5]
    assert docs.limit(0).select(quality.scorer(trees)("text")).count() == 0


def test_the_fit_is_bounded_and_repeatable(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    a, b = (quality.fit(docs.repartition(n), labels, sample=40) for n in (1, 3))
    assert (a.cut == b.cut).all() and (a.leaf == b.leaf).all()
