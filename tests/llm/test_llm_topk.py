import numpy as np

from reelrank.llm import topk


def brute(rows, k, every):
    out = []
    for q, v in rows:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k, every):
    df = spark.createDataFrame(rows, "id long, v array<long>")
    got = topk.top_k(df.where(df.id % every == 0), df, k)
    return sorted(tuple(r) for r in got.collect())


def test_like_comparing_all(spark, monkeypatch):
    rng = np.random.default_rng(1)
    # Few values, so ties abound; mostly zeros, so postings are short; lengths differ.
    rows = [(i, (rng.integers(-2, 3, rng.integers(1, 9)) * (rng.random() < 0.7)).tolist()) for i in range(300)]
    assert run(spark, rows, 5, 7) == brute(rows, 5, 7)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 10)
    assert run(spark, rows, 5, 7) == brute(rows, 5, 7)


def test_beyond_a_double(spark):
    rows = [(0, [2**27 + 1, 2**27]), (1, [2**27, 1]), (2, [2**27 - 1, 2]), (3, [1, 1])]
    assert run(spark, rows, 5, 3) == brute(rows, 5, 3)


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25]), (1, None), (2, [nan, 1.0]), (3, [None, 1.0]), (4, [inf, 0.0]), (None, [1.0, 1.0]),
        (5, [0.001, 0.999]), (5, [0.001, 0.999]), (6, []),
    ]
    df = spark.createDataFrame([(*r, "own") for r in rows], "vec_id long, embedding array<float>, id string")
    kept = {r["id"]: r["v"] for r in topk.quantized(df, "vec_id", "embedding", 256).collect()}
    assert kept == {0: [128, -64], 5: [0, 255], 6: []}
    vectors = topk.quantized(df, "vec_id", "embedding", 256)
    got = sorted(tuple(r) for r in topk.top_k(vectors.where("id = 0"), vectors, 5).collect())
    assert got == [(0, 1, 6, 0), (0, 2, 5, -64 * 255)]
    none = vectors.where("id < 0")
    assert topk.top_k(none, vectors, 5).count() == 0 and topk.top_k(vectors, none, 5).count() == 0
