"""Connected components by alternating large-star and small-star steps; roots of a forest by doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.llm.common import stored

MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (u, v); the label is the smallest node.

    Rows with a null end or equal ends link nothing. Every step is an
    aggregation with a join, so no star has to fit in one task; a round is
    written out and the rounds end when one changes nothing. Empty edges give
    an empty table.
    """
    edges = stored(
        edges.where("u IS NOT NULL AND v IS NOT NULL AND u != v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _sum(edges)
    for _ in range(MOST_ROUNDS if before[0] else 0):
        edges = stored(_small_star(_large_star(edges)), "edges")
        after = _sum(edges)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError("components did not settle")
    return _labels(edges)


def roots(parents: DataFrame) -> DataFrame:
    """``node, label`` for every node of a forest: ``parents`` (u, v) has one row for each u that has a parent, v < u.

    Equal to :func:`components` of these edges, as a root is the smallest node of its tree. A round is one join, which
    takes every node to the parent of its parent, so a tree of depth d needs about log2(d) rounds. Empty edges give an
    empty table.
    """
    parents = stored(parents.select("u", "v"), "parents")
    for _ in range(MOST_ROUNDS):
        up = parents.select(F.col("u").alias("_at"), F.col("v").alias("_up"))
        step = parents.join(up, parents["v"] == up["_at"], "left")
        jumped = stored(step.select("u", F.coalesce("_up", "v").alias("v"), F.col("_up").isNotNull().alias("moved")), "parents")
        if jumped.where("moved").isEmpty():
            return _labels(parents)
        parents = jumped.select("u", "v")
    raise RuntimeError("parents are no forest")


def _labels(stars: DataFrame) -> DataFrame:
    """A row for every node, of edges that all lead from a node to its label."""
    centres = stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(centres)


def _sum(edges: DataFrame) -> tuple:
    mark = F.xxhash64("u", "v")
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(mark).alias("x"),
                    F.sum(F.shiftright(mark, 20)).alias("s")).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of node and neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
