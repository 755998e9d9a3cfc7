"""Merkle manifest of a table: a tree of digests per key, a tree over their roots, proofs for all rows.

Checkpoint and recompute: rows are ranked within their tree, and of the tree's levels only the first and
every ``SPAN``-th one above are written. A proof goes down the written levels from the top: the nodes
below each aligned subtree are gathered, at most ``ARITY ** SPAN`` of them, the levels between are computed
once more from these, each node takes its siblings from them, and they are forgotten.

Ranking: one shuffle by ranges of key, order and digest, equal rows apart; a row's place is that of its file's
part of the tree plus its own in that part, so no task sees a whole tree. Trees of any size, and any number
of them, cost a group of bounded size per subtree; the texts are read once and never shuffled.

Built-in functions only. Defined cases: null fields are written as such, an empty text isn't one; long texts are
digested where they are read; null keys are a tree of their own, the first one; null orders come first, ties go by
digest, so that rows which are equal in all fields may change places but nothing else; an empty table gives
an empty result; columns that aren't named are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import named
from tidemark.llm.common import let, staged

ARITY = 3
#: Levels from one written level to the next.
SPAN = 4
MOST_LEVELS = 39  # 3 ** 39 is the last power of three that a long can hold
PATH = "array<struct<left:string,right:string>>"


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each value as its length in bytes, a colon and its text, ``-`` for null."""

    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(written, fields)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings on its way lead to."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def siblings_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level and left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(
    rows: DataFrame, fields: Sequence[str], tree: str, order: str, others: dict[str, Column] | None = None
) -> DataFrame:
    """``order``, ``leaf``, ``subroot`` of the row's tree, ``root`` over all trees and ``proof`` of each row.

    Trees are named by the text of ``tree``. ``proof`` is an array of ``left`` and ``right``, the digests of the
    siblings on each level from the leaf up, joined. ``others`` are more columns of the row to keep, by name.
    """
    key = F.coalesce(F.concat(F.lit("="), named(tree).cast("string")), F.lit("-"))
    digest = leaf_digest([named(f) for f in fields])
    own = F.struct(*[c.alias(n) for n, c in (others or {}).items()]) if others else F.lit(0)
    leaves = staged(
        rows.select(key.alias("tree"), named(order).alias("place"), digest.alias("digest"), own.alias("own")), "leaves"
    )
    trees = _levels(_ranked(leaves))
    subroots = trees[-1].select(
        F.lit("").alias("tree"), F.col("tree").alias("place"), "digest", F.lit(0).alias("own")
    )
    over = _levels(_ranked(subroots))
    above = over[-1].select("tree", F.lit("").alias("subroot"), F.col("digest").alias("root"), F.lit(None).cast(PATH).alias("path"))
    tops = _proofs(over, above).select(
        F.col("place").alias("tree"), F.col("digest").alias("subroot"), "root", "path"
    )
    return _proofs(trees, tops).select(
        F.col("place").alias(order),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        F.col("path").alias("proof"),
        *[F.col("own")[n].alias(n) for n in others or {}],
    )


def _ranked(nodes: DataFrame) -> DataFrame:
    """Nodes (``tree``, ``place``, ``digest``, ``own``) with ``at``, their rank in their tree from 0, and ``up``,
    how many levels are above them."""
    keys = ["tree", "place", "digest", "tie"]
    dealt = nodes.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys)
    ids = F.monotonically_increasing_id()
    placed = staged(
        dealt.sortWithinPartitions(*keys).drop("tie").withColumns({"part": F.spark_partition_id(), "id": ids}), "ranked"
    )
    runs = placed.groupBy("tree", "part").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    size = F.sum("n").over(whole)
    powers = F.array(*[F.lit(ARITY**i).cast("long") for i in range(MOST_LEVELS + 1)])
    runs = runs.select(
        "tree",
        "part",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        size.alias("size"),
    ).withColumn("up", F.size(F.filter(powers, lambda p: p < F.col("size"))))
    return placed.join(staged(runs, "runs"), ["tree", "part"]).select(
        "tree", (F.col("id") + F.col("shift")).alias("at"), "up", "place", "digest", "own"
    )


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """The levels that are written, the leaves' first, the roots' last."""
    levels = [nodes]
    most = nodes.agg(F.max("up")).first()[0] or 0
    for _ in range(0, most, SPAN):
        tops = _subtrees(levels[-1]).select(
            "tree",
            F.col("sub").alias("at"),
            (F.col("up") - F.col("climbed")).alias("up"),
            F.get(F.get("rows", F.col("climbed")), F.lit(0)).alias("digest"),
        )
        levels.append(staged(tops, "level"))
    return levels


def _subtrees(nodes: DataFrame, *more: str) -> DataFrame:
    """The aligned subtrees (``tree``, ``sub``) below a written level: their nodes with what is wanted ``more`` of
    them, in order, ``rows`` of digests level by level, and how many levels are ``climbed`` in them."""
    taken = F.sort_array(F.collect_list(F.struct("at", "digest", *more)))
    groups = nodes.groupBy("tree", "up", F.expr(f"at div {ARITY**SPAN}").alias("sub")).agg(taken.alias("nodes"))

    def next_row(row: Column) -> Column:
        last = F.ceil(F.size(row) / ARITY).cast("int") - 1
        join = lambda i: F.sha2(F.array_join(F.slice(row, i * ARITY + 1, F.lit(ARITY)), ""), 256)
        return F.transform(F.sequence(F.lit(0), last), join)

    rows = F.array(F.transform("nodes", lambda n: n["digest"]))
    grow = lambda rows, _: let(F.element_at(rows, -1), lambda row: F.concat(rows, F.array(next_row(row))))
    steps = F.array(*[F.lit(i) for i in range(SPAN)])
    return groups.withColumns(
        {"rows": F.aggregate(steps, rows, grow), "climbed": F.least("up", F.lit(SPAN))}
    )


def _proofs(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """All leaves with their roots and ``path``; ``tops`` has these of the roots, by ``tree``."""

    def down(above: DataFrame, level: DataFrame) -> DataFrame:
        more = [c for c in ("place", "own") if c in level.columns]
        above = above.select("tree", F.col("at").alias("sub"), "subroot", "root", "path")
        groups = _subtrees(level, *more).join(above, ["tree", "sub"])
        children = F.transform("nodes", lambda node, p: F.struct(node.alias("node"), _path(p).alias("path")))
        children = groups.select("tree", "subroot", "root", F.explode(children).alias("c"))
        return children.select("tree", "subroot", "root", "c.node.*", "c.path")

    def _path(p: Column) -> Column:
        steps = []
        for i in range(SPAN):
            row = F.get("rows", F.lit(i))
            q = F.floor(p / ARITY**i).cast("int")
            left = F.slice(row, q - q % ARITY + 1, q % ARITY)
            right = F.slice(row, q + 2, F.lit(ARITY - 1) - q % ARITY)
            steps.append(F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right")))
        return F.concat(F.slice(F.array(*steps), F.lit(1), F.col("climbed")), F.col("path"))

    none = F.array().cast(PATH)
    tops = tops.select("tree", "subroot", "root", F.coalesce("path", none).alias("path"))
    return reduce(down, reversed(levels[:-1]), levels[-1].join(tops, "tree"))
