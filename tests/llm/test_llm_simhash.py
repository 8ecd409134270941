import re

import numpy as np
import pytest
import xxhash

from reelrank.llm import simhash
from reelrank.llm.components import components


def slow_fingerprint(text, width):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(prints, bits):
    """component of each (doc_id, fingerprint) row."""
    group = list(range(len(prints)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= bits:
                x, y = find(i), find(j)
                group[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(prints):
        least[find(i)] = min(d, least.get(find(i), d))
    return [least[find(i)] for i in range(len(prints))]


def test_fingerprints(odd_rows):
    for _, text in odd_rows:
        for width in (1, 4):
            assert simhash.fingerprint(text, width) == slow_fingerprint(text, width)
    for n in range(1, 8):  # about the width
        text = " ".join("abcdefgh"[:n])
        assert simhash.fingerprint(text, 4) == slow_fingerprint(text, 4)


def clustered(n, seed):
    """Fingerprints with chains and balls of near ones, and far ones."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**64, n // 6, dtype=np.uint64)
    out = rng.choice(centres, n)
    for _ in range(4):
        out ^= np.where(rng.random(n) < 0.6, np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64), np.uint64(0))
    return np.unique(out)


@pytest.mark.parametrize("q", range(4))
def test_search_finds_what_a_quarter_can(q):
    fps = np.random.default_rng(q).permutation(clustered(900, q))
    members = 500
    root = simhash.search(fps, members, q, 4)
    part = simhash._quarter(fps, q)
    near = (np.bitwise_count(fps[:members, None] ^ fps[None]) <= 4) & (np.bitwise_count(part[:members, None] ^ part[None]) <= 1)
    a, b = np.nonzero(near)
    assert (root[a] == root[b]).all()
    # Nothing is joined that no chain of near pairs joins.
    whole = np.bitwise_count(fps[:, None] ^ fps[None]) <= 4
    label = np.arange(len(fps))
    for _ in range(50):
        label = np.array([label[row].min() for row in whole])
    assert (label == label[root]).all()


def test_links_connect_all_near_pairs_over_shards(spark, monkeypatch):
    for name, value in (("LEAF", 40), ("CHUNK", 60), ("VISITORS", 100)):
        monkeypatch.setattr(simhash, name, value)
    fps = clustered(1500, 9)
    # A third in one ball that no vantage point divides.
    ball = np.unique(fps[0] ^ (np.uint64(1) << np.arange(64, dtype=np.uint64)[:, None]) ^ (np.uint64(1) << np.arange(64, dtype=np.uint64)[None]))
    fps = np.unique(np.concatenate([fps, ball[:800]]))
    prints = [(i, int(f)) for i, f in enumerate(fps)]
    nodes = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    edges = simhash.link(nodes, 4)
    found = {r["node"]: r["component"] for r in components(edges).collect()}
    signed = {int(np.array([f], dtype=np.uint64).view(np.int64)[0]): f for _, f in prints}
    groups = {}
    for s, f in signed.items():
        groups.setdefault(found.get(s, s), set()).add(f)
    want = {}
    for (_, f), c in zip(prints, brute(prints, 4)):
        want.setdefault(c, set()).add(f)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 140 + i) for i in range(30)] + [(200, 200), (7, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{140 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies(make_docs, prose, odd_rows):
    text = prose(50, 400)
    rows = [*odd_rows, (20, text), (21, text), (22, text.upper()), (19, text + " more"), (23, prose(51, 400))]
    out = simhash.near_duplicates(make_docs(rows), 4, 4).collect()
    assert len(out) == len(rows)
    prints = [(d, slow_fingerprint(t, 4)) for d, t in rows if d is not None]
    want = sorted((d, f, c) for (d, f), c in zip(prints, brute(prints, 4)))
    assert sorted((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in out if r["doc_id"] is not None) == want
    assert all(r["component_id"] is None for r in out if r["doc_id"] is None)
    kept = simhash.keep_one(make_docs(rows), 4, 4)
    ids = [r["doc_id"] for r in kept.collect()]
    assert set(ids) == {None, *{c for *_, c in want}} and ids.count(None) == 2
    assert simhash.near_duplicates(make_docs(rows).limit(0), 4, 4).count() == 0


def test_hex_digits(spark):
    df = spark.sql("SELECT -1L AS a, 255L AS b, 0L AS c")
    assert list(df.select(*map(simhash.hex_digits, (df.a, df.b, df.c))).first()) == ["f" * 16, "00000000000000ff", "0" * 16]
