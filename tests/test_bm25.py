"""Item neighbours against a dense computation, on every path."""

import subprocess
import sys
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelrank.operators import bm25, gram
from reelrank.session import materialize

K = 7


@pytest.fixture(scope="module")
def watched():
    """60 users x 25 items; users 0 and 1 saw nearly everything."""
    rng = np.random.default_rng(3)
    seen = rng.random((60, 25)) < 0.2
    seen[0] = True
    seen[1] = rng.random(25) < 0.8
    seen[:, 0] |= rng.random(60) < 0.5
    return seen[:, seen.any(axis=0)]


@pytest.fixture(scope="module")
def log(spark, watched):
    users, items = np.nonzero(watched)
    pdf = pd.DataFrame({"user_id": users.astype("int64"), "item_id": items.astype("int64") * 3})
    return materialize(spark.createDataFrame(pdf))


def dense(seen):
    n_i, n_u = seen.sum(axis=0), seen.sum(axis=1)
    a = 2.1 / (1.1 * (0.6 + 0.4 * n_i / n_i.mean()) + 1)
    b = np.where(n_u > 0, np.log(seen.shape[1]) - np.log(1 + n_u), 0)
    q = np.round(b * b * bm25.UNIT)
    shared = (seen * q[:, None]).T @ seen
    common = seen.T.astype(int) @ seen
    return a, shared, common


def neighbours(seen, k):
    a, shared, common = dense(seen)
    out = {}
    for i in range(seen.shape[1]):
        strength = a * (shared[i] / bm25.UNIT)
        near = [j for j in range(seen.shape[1]) if common[i, j]]
        near.sort(key=lambda j: (-strength[j], j))
        for place, j in enumerate(near[:k], 1):
            out[i * 3, j * 3] = (place, a[i] * strength[j])
    return out


def collected(sim):
    return {(r.item_i, r.item_j): (r.rank, r.similarity) for r in sim.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for key, (place, value) in want.items():
        assert got[key][0] == place
        assert got[key][1] == pytest.approx(value, rel=1e-9)


def test_similarity(log, watched):
    same(collected(bm25.item_similarity(log, K)), neighbours(watched, K))


# Many blocks; some items hot, their users shared out among tasks; all items hot.
@pytest.mark.parametrize("sizes", [gram.Sizes(sums=40, at_once=7), gram.Sizes(products=300, at_once=3), gram.Sizes(products=10)])
def test_similarity_in_small_blocks(log, watched, sizes):
    same(collected(bm25.item_similarity(log, K, sizes=sizes)), neighbours(watched, K))


def test_no_log_no_neighbours(log):
    assert bm25.item_similarity(log.limit(0)).count() == 0


def test_no_pairs_are_sent(log):
    """Histories go to blocks of items; a log row is copied once per block at most, and nothing is grouped by pair."""
    plan = bm25.item_similarity(log, K)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Aggregate" not in plan and "Window" not in plan


def test_sparse_sums():
    rng = np.random.default_rng(5)
    sums, want = gram.SparseSums(50), {}
    for _ in range(40):
        codes, values = rng.integers(0, 100, 17), rng.integers(0, 1 << 50, 17)
        sums.add(codes, values)
        for c, v in zip(codes.tolist(), values.tolist()):
            want[c] = want.get(c, 0) + v
    sums.settle()
    assert dict(zip(sums.codes.tolist(), sums.values.tolist())) == want


def test_dense_sums_hold_a_cell_per_code_and_nothing_waits():
    rng = np.random.default_rng(5)
    dense_sums, sparse = gram.DenseSums(100), gram.SparseSums(50)
    for _ in range(40):
        codes, values = rng.integers(0, 90, 17), rng.integers(0, 1 << 50, 17) * rng.integers(0, 2, 17)
        dense_sums.add(codes, values)
        sparse.add(codes, values)
    dense_sums.settle()
    sparse.settle()
    assert dense_sums.codes.tolist() == sparse.codes.tolist() and dense_sums.values.tolist() == sparse.values.tolist()


def test_long_histories_are_added_in_stretches():
    items = pa.array([list(range(n)) for n in (3, 3, 9, 0, 1)], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([items, pa.array(range(5))], names=["items", "nth"])
    parts = list(gram._cut_batches(iter([batch, batch.slice(0, 0)]), 6))
    assert [p.column("nth").to_pylist() for p in parts] == [[0, 1], [2], [3, 4]]


SIMILARITY_MEMORY = """
import resource
import numpy as np, pyarrow as pa
from reelrank.operators import gram
rng = np.random.default_rng(1)
items, blocks = 200_000, 2000
def batches():
    for _ in range(40):
        history = np.sort(rng.integers(0, items, (500, 2000)), axis=1)
        history[:, 0] = 0
        flat = history.ravel()
        at = pa.array(np.arange(501, dtype=np.int32) * 2000)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.zeros(500, dtype=np.int32)), pa.array(np.full(500, -1, dtype=np.int32)), pa.array(np.full(500, 10**10)),
            pa.ListArray.from_arrays(at, pa.array(flat.astype(np.int32))), pa.ListArray.from_arrays(at, pa.array(np.full(len(flat), 9, dtype=np.int32))),
        ], names=["key", "only", "q", "items", "counts"])
found = sum(b.num_rows for b in gram._rows_of(batches(), blocks, items, 210, lambda s, n: s / n, gram.Sizes()))
assert found == 100 * 210
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024)
"""


def test_memory_of_a_block_of_sums_is_bounded():
    """20,000 users with 2,000 items each, all with one item of the block: over 40 million products, 20 million sums."""
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", SIMILARITY_MEMORY], cwd=root, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr
    assert float(done.stdout) < 2048


def lists(log, sim, n, **options):
    rows = bm25.neighbour_lists(log, sim, n, **options).toPandas()
    rows["order"] = rows["score"].round(9)
    rows = rows.sort_values(["user_id", "order", "item_id"], ascending=[True, False, True])
    return {u: list(zip(g.item_id[:n], g.order[:n])) for u, g in rows.groupby("user_id")}


@pytest.fixture(scope="module")
def sim(log):
    return materialize(bm25.item_similarity(log, K))


def expected_lists(seen, sim, n):
    table = {}
    for r in sim.collect():
        table.setdefault(r.item_i, []).append((r.item_j, r.similarity))
    out = {}
    for user in range(len(seen)):
        history = {int(i) * 3 for i in np.flatnonzero(seen[user])}
        scores = {}
        for i in sorted(history):
            for j, s in table[i]:
                scores[j] = scores.get(j, 0.0) + s
        best = sorted(((j, round(s, 9)) for j, s in scores.items() if j not in history), key=lambda p: (-p[1], p[0]))
        if best:
            out[user] = best[:n]
    return out


@pytest.mark.parametrize(
    "options", [{}, {"products": 40, "held": 20}, {"products": 10}, {"held": 3}]
)
def test_neighbour_lists(log, watched, sim, options):
    got, want = lists(log, sim, 5, **options), expected_lists(watched, sim, 5)
    assert got.keys() == want.keys()
    for user in want:
        assert [i for i, _ in got[user]] == [i for i, _ in want[user]]
        assert [s for _, s in got[user]] == pytest.approx([s for _, s in want[user]])


def test_lists_below_the_bar_are_not_sent(spark, log, watched, sim):
    """Many item blocks: a first pass finds how good a row must be. A user without an id keeps a list as well."""
    unnamed = log.where("user_id = 7").select(F.lit(None).cast("bigint").alias("user_id"), "item_id")
    log = materialize(log.unionByName(unnamed))
    options = {"held": 20, "products": 40}
    whole = bm25.neighbour_lists(log, sim, 5, **options)
    cut = materialize(bm25.neighbour_lists(log, sim, 5, **options, bar_rows=0))
    assert cut.count() < whole.count()
    order = Window.partitionBy("user_id").orderBy(F.desc(F.round("score", 9)), "item_id")
    best = [sorted(map(str, df.withColumn("r", F.row_number().over(order)).where("r <= 5").collect())) for df in (whole, cut)]
    assert best[0] == best[1]
    assert cut.where("user_id is null").count() >= 5
    got, want = lists(log.where("user_id is not null"), sim, 5, **options, bar_rows=0), expected_lists(watched, sim, 5)
    assert {u: [i for i, _ in got[u]] for u in got} == {u: [i for i, _ in want[u]] for u in want}


def test_grid():
    """A catalogue of ten million items: fewer copies of the log than products; bytes near the least there is."""
    rows, users, n, items = 10**12, 10**9, 400, 10**7
    down, across = bm25.grid(rows, users, n, 210 * items, items, 4000)
    assert across < bm25.NEIGHBOURS and 210 * items / across <= bm25.HELD
    assert down * across >= rows * 210 / bm25.TASK_PRODUCTS
    # Nothing is cut that fits one task, and a small log gets a block for every core.
    assert bm25.grid(100, 10, 5, 1000, 50, 1) == (1, 1)
    down, across = bm25.grid(600_000, 15_000, 100, 4_200_000, 20_000, 8)

    def sent(down, across):
        return across * (600_000 * bm25.ROW_BYTES + 15_000 * 100 * bm25.LIST_BYTES) + down * 4_200_000 * bm25.SIM_BYTES

    assert down * across >= 8 and sent(down, across) == min(sent(-(-8 // a), a) for a in range(1, 9))


def test_small_cells(log, watched, sim, monkeypatch):
    history = log.select("user_id", "item_id").toPandas()
    monkeypatch.setattr(bm25, "SCORE_CELLS", 10)
    got = bm25._block_lists(history, sim.toPandas(), 5)
    assert got.groupby("user_id").size().max() <= 5
    assert set(got.user_id) == set(expected_lists(watched, sim, 5))


MEMORY = """
import resource, sys
import numpy as np, pandas as pd
from reelrank.operators import bm25, gram
rng = np.random.default_rng(1)
users, items, k = 4000, 1000, 210
picked = np.argsort(rng.random((users, items)), axis=1)[:, :500]
history = pd.DataFrame({"user_id": np.repeat(np.arange(users), 500), "item_id": picked.ravel()})
near = pd.DataFrame({"item_i": np.repeat(np.arange(items), k), "item_j": np.argsort(rng.random((items, items)), axis=1)[:, :k].ravel()})
near["similarity"] = rng.random(len(near))
found = bm25._block_lists(history, near, 20)
assert len(found) == users * 20
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024)
"""


def test_memory_of_a_block_is_bounded():
    """2 million log rows of long histories: 420 million products stay under a gigabyte."""
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", MEMORY], cwd=root, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr
    assert float(done.stdout) < 1024


def test_products_in_slices(log, watched, sim, monkeypatch):
    history, near = log.select("user_id", "item_id").toPandas(), sim.toPandas()
    want = bm25._block_lists(history, near, 5)
    monkeypatch.setattr(bm25, "PRODUCTS", 3)
    assert bm25._block_lists(history, near, 5).equals(want)


def test_scores_that_round_either_way_are_kept():
    # Items 1 and 2 differ by half a unit of the ninth digit; rounded down it is a tie that goes to item 1.
    near = pd.DataFrame({"item_i": 9, "item_j": [3, 1, 2], "similarity": [2.0, 1.0000000005, 1.0]})
    history = pd.DataFrame({"user_id": [1], "item_id": [9]})
    assert {3, 1} == set(bm25._block_lists(history, near, 2).item_id)
    near["similarity"] = [2.0, 1.0, 1.0000000005]
    # Rounded up, item 2 comes second: the window decides.
    assert {3, 1, 2} == set(bm25._block_lists(history, near, 2).item_id)
