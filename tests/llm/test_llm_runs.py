import hashlib
import random
import time
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reelrank.llm import queries, runs


def slow_runs(w, least=6, times=4):
    """Every period tried on every stretch."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def slow_collapse(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return b" ".join(x for i, x in enumerate(w) if i not in gone)


pieces = st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c"]), min_size=1, max_size=5), st.integers(1, 9)), max_size=6)


@settings(max_examples=300, deadline=None)
@given(st.lists(pieces, max_size=4), st.sampled_from([(6, 4), (2, 2), (6, 3), (12, 2)]))
def test_like_trying_every_period(made, bounds):
    texts = [[w for unit, n in parts for w in unit * n] for parts in made]
    found = runs.runs_of(texts, *bounds)
    assert found == [slow_runs(t, *bounds) for t in texts]
    assert [runs.collapsed(t, f) for t, f in zip(texts, found)] == [slow_collapse(t, f) for t, f in zip(texts, found)]


def test_smallest_period_and_borders():
    w = "x ab ab ab ab ab ab y".split()
    assert runs.runs_of([[x.encode() for x in w]]) == [[(1, 6, 1)]]
    assert runs.runs_of([[b"a", b"b"] * 4]) == [[(0, 8, 2)]]
    assert runs.runs_of([[b"a", b"b"] * 3 + [b"a"]]) == [[]]  # seven words are less than four periods
    assert runs.runs_of([[b"a"] * 5]) == [[]]
    assert runs.runs_of([[b"a"] * 3, [b"a"] * 3]) == [[], []]  # texts do not run on into one another
    assert runs.runs_of([]) == []
    with pytest.raises(ValueError):
        runs.runs_of([[b"a"]], 6, 1)


def test_work_stays_near_the_number_of_words():
    rng, started = random.Random(3), time.time()
    fibonacci, longer = [b"a"], [b"a", b"b"]
    while len(longer) < 50_000:
        fibonacci, longer = longer, longer + fibonacci
    texts = [
        [b"a"] * 100_000,
        [b"a", b"b", b"c"] * 50_000,
        [w for i in range(20_000) for w in (b"x%d" % i, b"A", b"B", b"C", b"D", b"E")],
        ([b"a"] * 50 + [b"b"]) * 2000,
        longer,
        [b"%d" % rng.randrange(50) for _ in range(200_000)],
    ]
    found = [runs.runs_of([t])[0] for t in texts]
    assert found[0] == [(0, 100_000, 1)] and found[1] == [(0, 150_000, 3)] and found[2] == []
    assert found[3][0] == (0, 50, 1) and (0, 102_000, 51) in found[3] and len(found[3]) == 2001
    assert time.time() - started < 60


def test_odd_rows(make_docs, odd_rows):
    rows = [*odd_rows, (8, "go on " * 9), (8, "go on " * 9), (9, "a\x0bb\x0ca\rb\ta\nb a b a\xa0b"), (10, "la " * 30000)]
    docs = make_docs(rows)
    got = runs.periodic_runs(docs).collect()
    assert len(got) == len(rows)
    words = {r: (r[1] or "").encode().split() for r in rows}
    want = sorted((str(r[0]), len(words[r]), str(slow_runs(words[r][:70])) if r[0] != 5 else None) for r in rows if r[0] != 10)
    assert want == sorted((str(r.doc_id), r.n_words, str([tuple(x) for x in r.runs]) if r.doc_id != 5 else None) for r in got if r.doc_id != 10)
    by_id = {r.doc_id: r for r in got}
    assert by_id[8].collapsed == "go on" and [tuple(x) for x in by_id[8].runs] == [(0, 18, 2)]
    assert by_id[10].collapsed == "la" and by_id[1].collapsed == by_id[2].collapsed == by_id[3].collapsed == ""
    assert by_id[9].runs == [(0, 8, 2)] and by_id[9].n_words == 9  # a no-break space is part of a word
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def planted(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    return w


def test_the_query_on_whole_texts(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op13_runs(spark, sf_dir).collect()
    assert len(got) == len(texts) and sum(r.n_runs > 0 for r in got) > len(texts) / 30
    for r in got:
        w = planted(r.doc_id, texts[r.doc_id])
        found = slow_runs(w)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(slow_collapse(w, found)).hexdigest()
