import math
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelrank.llm import language, queries


def slow_symbols(text):
    text = (text or "").lower()
    if not any(unicodedata.category(c).startswith("L") for c in text):
        return ""
    kept = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text)
    return re.sub(" +", " ", f" {kept} ")


def slow_grams(s):
    return {s[i : i + n] for n in range(1, 5) for i in range(len(s) - n + 1)}


def test_symbols(odd_rows):
    for _, text in [*odd_rows, (0, "a"), (0, "1 2 3"), (0, "क्या 1 नहीं"), (0, "Ⅷ ½"), (0, "-é-")]:
        assert "".join(map(chr, language.symbols(text))) == slow_symbols(text)


def test_kernel_counts_shared_grams():
    texts = ["the cat sat on the mat", "the dog sat", "le chat est là", "ßüß", "x"]
    rows = language.presence([language.symbols(t) for t in texts])
    sets = [slow_grams(slow_symbols(t)) for t in texts]
    assert [len(np.unique(language.grams(language.symbols(t)))) for t in texts] == [len(s) for s in sets]
    want = [[len(a & b) / math.sqrt(len(a) * len(b)) for b in sets] for a in sets]
    assert np.allclose(rows @ rows.T, want, atol=0.03)  # two grams may hash to one place


def test_windows_hold_every_gram(prose):
    codes = language.symbols(prose(1, 4000))
    cut = language.windows(codes)
    assert len(cut) > 1 and max(map(len, cut)) <= language.WINDOW + language.WIDEST
    assert set(language.grams(codes)) == set(np.concatenate([language.grams(w) for w in cut]))
    marks = language.presence([language.symbols("ta ri mon"), language.symbols("zzz")]).T
    mean = np.mean(language.presence(cut) @ marks, axis=0)
    found, known = language.features([prose(1, 4000), None, "12", "ta"], marks)
    assert np.allclose(found[0], mean) and known.tolist() == [True, False, False, True]


def test_solution_is_ridge_regression_in_the_span_of_the_landmarks():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 5))
    marks = rng.normal(size=(8, 5))
    labels = rng.integers(0, 3, 60)
    weights, bias = language.solve(x @ marks.T, labels, 3, marks @ marks.T)
    # With more landmarks than dimensions the features are the plain coordinates, up to a rotation.
    y = np.where(labels[:, None] == np.arange(3), 1.0, -1.0)
    w = 1 / np.bincount(labels)[labels]
    w = w / w.sum()
    xc, yc = x - w @ x, y - w @ y
    a = np.linalg.solve(xc.T @ (w[:, None] * xc) + language.RIDGE * np.eye(5), xc.T @ (w[:, None] * yc))
    assert np.allclose(x @ marks.T @ weights + bias, xc @ a + w @ y, atol=1e-6)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    true = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text").collect()}
    got = queries.op11_language(spark, sf_dir).collect()
    assert len(got) == len(true)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == true[r.doc_id].lang for r in held]) > 0.98
    by_lang = {l: [r for r in held if true[r.doc_id].lang == l] for l in {t.lang for t in true.values()}}
    assert all(np.mean([r.lang_pred == l for r in rows]) > 0.95 for l, rows in by_lang.items())


@pytest.fixture(scope="module")
def two_tongues(spark):
    rows = [(i, f"the cat and the dog number {i} with them", "en") for i in range(40)]
    rows += [(100 + i, f"le chat et le chien dans la maison {i} avec eux", "fr") for i in range(8)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_odd_rows(spark, two_tongues, make_docs, odd_rows):
    extra = [(None, "le chien", "fr"), (200, None, "fr"), (201, "12", "de"), (202, "ohne", None), (0, "the cat and the dog number 0 with them", "en")]
    learnt = two_tongues.unionByName(spark.createDataFrame(extra, two_tongues.schema))
    model = language.fit(learnt)
    assert model.languages == ["en", "fr"]
    again = language.fit(learnt.repartition(3))
    assert np.array_equal(model.landmarks, again.landmarks) and np.allclose(model.weights, again.weights)
    rows = [*odd_rows, (7, "le chat dans la maison"), (7, "the dog with them"), (8, "12 + 3"), (9, "the dog with them " * 20000)]
    docs = make_docs(rows).withColumn("lang", F.lit("fr")).withColumn("score", F.lit("own"))
    got = docs.select("doc_id", "text", language.predictor(model)("text").alias("p")).collect()
    assert len(got) == len(rows)
    by_text = {r.text: r.p for r in got}
    assert by_text["le chat dans la maison"].lang == "fr" and by_text["the dog with them"].lang == "en"
    assert by_text["the dog with them " * 20000].lang == "en"
    assert all((r.p.lang == "und") == (not re.search(r"[^\W\d_]", r.text or "")) for r in got)
    assert all(r.p.score == 0 for r in got if r.p.lang == "und") and all(0 <= r.p.score <= 1 for r in got)
    assert docs.limit(0).select(language.predictor(model)("text")).count() == 0


def test_none_and_one_language(two_tongues):
    none = language.fit(two_tongues.limit(0))
    assert none.predict(["the cat", None]).values.tolist() == [["und", 0.0], ["und", 0.0]]
    one = language.fit(two_tongues.where("lang = 'fr'"))
    assert one.predict(["the cat", None]).values.tolist() == [["fr", 1.0], ["und", 0.0]]


def test_the_fit_is_bounded_and_even(spark, two_tongues):
    chosen = language._evenly(two_tongues.withColumns({"_h": F.xxhash64("doc_id"), "_t": F.xxhash64("text")}), 12).collect()
    assert len(chosen) == 12 and sum(r.lang == "fr" for r in chosen) == 6
    assert language.fit(two_tongues, sample=10, landmarks=4).landmarks.shape == (language.PLACES, 4)
