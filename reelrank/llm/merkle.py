"""Merkle manifest of a table: one root over all rows, and a proof for every row.

Every source has a tree: its leaves in order, every ``ARITY`` consecutive nodes hashed together, level by level, until
one node is left. These subroots, ordered by source, are the leaves of one more tree, whose last node is the root.

Of a tree only every ``STRIDE``-th level is stored. The stored nodes are grouped into aligned subtrees of
``ARITY ** STRIDE`` nodes under one node of the next stored level; a subtree is an array of 81 digests, so its
interior levels are recomputed from it wherever they are needed, used, and forgotten. ``manifest`` does so upwards to
find the roots, ``proofs`` downwards: each subtree takes the path of its top node, regenerates its interior, and puts
the siblings of every member before that path. A path travels once per subtree, and only the last step has a
row per leaf.

Nothing is held by source. Rows are numbered in ranges of (source, id), so a source with a third of the rows lies
in many tasks; subtrees are spread by source and number. There are log81 of the largest source steps, each a stored
table, so a lost executor costs one step. All hashes are Spark expressions.

Defined results: a null field counts as '-'. Leaves of one source and id are ordered by digest. A null source is one
source, before all others; rows without an id come first in theirs. A lone leaf is its source's subroot, a lone
subroot the root; a run of one node is hashed like any other. Very long texts are hashed whole. No rows: no nodes,
no proofs. Columns that are not named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelrank.llm.frames import blocks
from reelrank.session import materialize

ARITY = 3
STRIDE = 4
SUBTREE = ARITY**STRIDE
#: Rows that one task numbers.
RANGE_ROWS = 1_000_000
PATH = "array<struct<before:string,after:string>>"


def digest(*fields: Column) -> Column:
    """Leaf digest of the fields: each '-' if null, else its UTF-8 length, a colon and the value."""

    def framed(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(framed, fields)), 256)


def _levels_above(n: Column) -> Column:
    """Levels over ``n`` leaves until one node is left."""
    powers = F.array(*[F.lit(ARITY**k).cast("long") for k in range(39)])
    return F.size(F.filter(powers, lambda p: p < n))


def _numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` with ``at``, their place in their tree from 0, and ``depth``, the levels over them.

    Rows are dealt out in ranges of (tree, order...), the last resort being their place in the input, so neither a
    large tree nor rows that repeat meet in one task.
    """
    rows = leaves.count()
    cores = leaves.sparkSession.sparkContext.defaultParallelism
    keys = [F.col("tree"), *[F.col(c).asc_nulls_first() for c in order], F.col("_nth")]
    ranged = leaves.withColumn("_nth", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange(max(blocks(rows, RANGE_ROWS), min(cores, blocks(rows, 1000))), *keys).sortWithinPartitions(*keys)
    # Stored: the numbers of a partition's rows must stand whatever reads them.
    held = materialize(ranged.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}))
    # A row per tree and partition that has rows of it: fewer than trees and partitions together.
    spans = held.groupBy("tree", "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    tree = Window.partitionBy("tree")
    earlier = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "tree",
        "_part",
        (F.col("_first") - F.coalesce(F.sum("_n").over(earlier), F.lit(0))).alias("_zero"),
        _levels_above(F.sum("_n").over(tree)).alias("depth"),
    )
    return held.join(spans, ["tree", "_part"]).select(*leaves.columns, (F.col("_row") - F.col("_zero")).alias("at"), "depth")


def _subtrees(nodes: DataFrame, step: int) -> DataFrame:
    """The nodes of level ``step * STRIDE`` in aligned subtrees: tree, depth, block, climb, members, and ``_0`` .. the
    digests of every level from the members up to the top one, all but the first recomputed here.

    ``climb`` is the number of levels up to the subtree's top: fewer than STRIDE where the tree ends before.
    """
    columns = ["at", "digest", *[c for c in nodes.columns if c not in ("tree", "at", "depth", "digest")]]
    block = F.expr(f"at div {SUBTREE}").alias("block")
    made = nodes.groupBy("tree", "depth", block).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("members"))
    made = made.withColumn("climb", F.least(F.lit(STRIDE), F.col("depth") - step * STRIDE)).withColumn("_0", F.col("members.digest"))
    for i in range(1, STRIDE + 1):
        below = f"_{i - 1}"
        runs = F.sequence(F.lit(0), F.expr(f"int((size({below}) - 1) div {ARITY})"))
        above = F.transform(runs, lambda r: F.sha2(F.array_join(F.slice(below, r * ARITY + 1, F.lit(ARITY)), ""), 256))
        made = made.withColumn(f"_{i}", F.when(F.col("climb") >= i, above).otherwise(F.col(below)))
    return made


@dataclass(frozen=True)
class Forest:
    """Trees of which every ``STRIDE``-th level is stored.

    ``nodes[k]`` (tree, at, depth, digest): the nodes of level k * STRIDE of the trees that are higher; ``nodes[0]`` are the
    leaves with their own columns. ``roots`` (tree, depth, digest).
    """

    nodes: list[DataFrame]
    roots: DataFrame


def forest(leaves: DataFrame, order: list[str]) -> Forest:
    """Trees over ``leaves`` (tree string, digest, other columns), whose leaves ascend by ``order``."""
    nodes, roots = [materialize(_numbered(leaves, order))], None
    deepest = nodes[0].agg(F.max("depth")).first()[0] or 0
    while True:
        step = len(nodes)
        tops = _subtrees(nodes[-1], step - 1).select("tree", F.col("block").alias("at"), "depth", F.element_at(f"_{STRIDE}", 1).alias("digest"))
        tops = materialize(tops)
        ended = tops.where(F.col("depth") <= step * STRIDE).select("tree", "depth", "digest")
        roots = ended if roots is None else roots.unionByName(ended)
        if deepest <= step * STRIDE:
            return Forest(nodes, roots)
        nodes.append(tops.where(F.col("depth") > step * STRIDE))


def _siblings(i: Column) -> Column:
    """Path of the i-th member (from 0) to its subtree's top: what stands before and after it in its run, by level."""
    steps = []
    for level in range(STRIDE):
        own = F.floor(i / ARITY**level).cast("int")
        run = own - own % ARITY
        before, after = F.slice(f"_{level}", run + 1, own - run), F.slice(f"_{level}", own + 2, run + ARITY - 1 - own)
        steps.append(F.struct(F.array_join(before, "").alias("before"), F.array_join(after, "").alias("after")))
    return F.slice(F.array(*steps), F.lit(1), F.col("climb")).cast(PATH)


def _downward(made: Forest, tops: DataFrame) -> DataFrame:
    """The leaves of a forest with ``path`` and all columns of ``tops`` (tree, depth, path, others) of their tree."""
    carried = [c for c in tops.columns if c not in ("tree", "depth", "path")]
    known = None
    for step in range(len(made.nodes) - 1, -1, -1):
        ending = F.col("depth") <= (step + 1) * STRIDE
        ending = ending & (F.col("depth") > step * STRIDE) if step else ending
        above = tops.where(ending).select("tree", F.lit(0).cast("long").alias("block"), "path", *carried)
        if known is not None:
            above = above.unionByName(known.select("tree", F.col("at").alias("block"), "path", *carried))
        joined = _subtrees(made.nodes[step], step).join(above, ["tree", "block"])
        # A path is written once per subtree; its members get it here.
        members = F.transform("members", lambda m: F.struct(m.alias("m"), _siblings(m["at"] % SUBTREE).alias("own")))
        each = joined.select("tree", "path", *carried, F.explode(members).alias("e"))
        known = each.select("tree", "e.m.*", F.concat("e.own", "path").alias("path"), *carried)
        if step:
            known = materialize(known)
    return known


@dataclass(frozen=True)
class Manifest:
    """The trees of all sources, the tree over their subroots, and the root (None without rows)."""

    sources: Forest
    top: Forest
    root: str | None


def manifest(rows: DataFrame, source: str, order: list[str]) -> Manifest:
    """Manifest of ``rows`` (digest, ``source``, ``order``, other columns); rows ascend by ``order``, then digest."""
    key = F.coalesce(F.concat(F.lit("+"), F.col(source).cast("string")), F.lit(""))  # null before all, then bytewise
    trees = forest(rows.withColumn("tree", key), [*order, "digest"])
    subroots = trees.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "depth", "digest")
    top = forest(subroots.withColumnRenamed("depth", "levels"), ["name"])
    root = top.roots.select("digest").first()
    return Manifest(trees, top, root and root[0])


def proofs(made: Manifest) -> DataFrame:
    """All leaves with their columns, ``subroot``, ``root`` and ``path``: from the leaf up, what stands before and after."""
    none = F.array().cast(PATH)
    top = _downward(made.top, made.top.roots.select("tree", "depth", none.alias("path")))
    tops = top.select(F.col("name").alias("tree"), F.col("levels").alias("depth"), "path", F.col("digest").alias("subroot"))
    return _downward(made.sources, materialize(tops)).withColumn("root", F.lit(made.root).cast("string"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path give."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def path_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)


__all__ = ["Forest", "Manifest", "digest", "folded", "forest", "manifest", "path_digest", "proofs"]
