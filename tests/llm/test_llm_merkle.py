import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from reelrank.llm import merkle, queries


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def slow_tree(leaves):
    """Root, and per leaf the (before, after) of every level."""
    paths, level, places = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for path, i in zip(paths, places):
            first = i // 3 * 3
            path.append(("".join(level[first:i]), "".join(level[i + 1 : first + 3])))
        level = [H(*level[i : i + 3]) for i in range(0, len(level), 3)]
        places = [i // 3 for i in places]
    return level[0], paths


def slow_manifest(rows):
    """(source, id, digest) -> rows with subroot, root and path, in any order."""
    by_source = defaultdict(list)
    for source, key, digest in rows:
        by_source[source].append((key is not None, key or 0, digest, key))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: slow_tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in sources}
    root, above = slow_tree([trees[s][0] for s in sources])
    out = []
    for s, upper in zip(sources, above):
        for x, path in zip(sorted(by_source[s], key=lambda x: x[:3]), trees[s][1]):
            out.append((s, x[3], x[2], trees[s][0], root, path + upper))
    return out


def as_tuple(r):
    return (r.source, r.id, r.digest, r.subroot, r.root, [tuple(p) for p in r.path])


def in_order(rows):
    return sorted(rows, key=str)


# Sources of no more than a subtree, of several, and of more than a subtree of subtrees; and more sources than one subtree holds.
@pytest.mark.parametrize("sizes", [[1], [2], [3], [4, 1], [81, 82, 27, 28, 1], [243, 244, 9, 10], [6600, 80, 1], [1] * 100 + [5, 90]])
def test_like_the_whole_tree(spark, sizes):
    rng = random.Random(len(sizes))
    names = [None, "", "é", "z", "Z", "~"] + [f"s{i}" for i in range(100)]
    rows = [(names[k], i - 3, H(str(k), str(i))) for k, n in enumerate(sizes) for i in range(n)]
    rng.shuffle(rows)
    made = merkle.manifest(spark.createDataFrame(rows, "source string, id long, digest string"), "source", ["id"])
    proofs = merkle.proofs(made).withColumn("folded", merkle.folded(F.col("digest"), F.col("path")))
    got = proofs.withColumn("pd", merkle.path_digest(F.col("path"))).collect()
    assert in_order(map(as_tuple, got)) == in_order(slow_manifest(rows))
    for r in got:
        assert r.folded == made.root and r.pd == H(*(b + a for b, a in r.path))
    assert len(made.sources.nodes) == max(1, -(-merkle_depth(max(sizes)) // merkle.STRIDE))


def merkle_depth(n):
    depth = 0
    while n > 1:
        n, depth = -(-n // 3), depth + 1
    return depth


def test_only_every_few_levels_are_stored(spark):
    rows = spark.range(1000).select(F.lit("s").alias("source"), "id", F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    stored = merkle.manifest(rows, "source", ["id"]).sources.nodes
    assert [n.count() for n in stored] == [1000, 13]


def test_odd_rows(spark):
    rows = [("a", None, H("1")), ("a", None, H("2")), ("a", 4, H("3")), ("a", 4, H("3")), ("a", 4, H("0")), (None, 1, H("4")), (None, None, H("4"))]
    frame = spark.createDataFrame(rows, "source string, id long, digest string")
    clashing = {c: F.lit("own") for c in ["block", "members", "climb", "part", "n", "name", "own", "e", "m", "before", "after"]}
    got = merkle.proofs(merkle.manifest(frame.withColumns(clashing), "source", ["id"])).collect()
    assert in_order(map(as_tuple, got)) == in_order(slow_manifest(rows)) and got[0].members == "own"
    empty = merkle.manifest(frame.limit(0), "source", ["id"])
    assert empty.root is None and merkle.proofs(empty).count() == 0


def test_digest_of_fields(spark):
    frame = spark.createDataFrame([(7, "é", None, ""), (None, None, None, "x" * 100_000)], "a long, b string, c long, d string")
    got = [r[0] for r in frame.select(merkle.digest(*map(F.col, "abcd"))).collect()]
    assert got == [H("1:7", "2:é", "-", "0:"), H("-", "-", "-", "100000:", "x" * 100_000)]


def test_tampering_shows(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op12_merkle(spark, sf_dir).collect()
    assert len(got) == len(docs) and len({r.root for r in got}) == 1
    framed = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    for r in got:
        d = docs[r.doc_id]
        altered = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (d.text or "")
        assert r.leaf == H(*map(framed, (d.doc_id, d.source, d.lang, d.n_chars, d.text)))
        assert r.verified == (not altered) == (r.folded_root == r.root)
    assert 0 < sum(r.verified for r in got) < len(got)
