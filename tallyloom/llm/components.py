"""Connected components of links, as joins and aggregates over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import written


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the links ``(a, b)``; the component is its smallest node.

    Links are first folded onto smallest neighbours. Then large-star and small-star steps in turn: each links a node's neighbours to its smallest
    neighbour, until all are stars. A node's neighbours meet only in a partial minimum and in a join of
    written tables that adaptive execution can split, so a node with very many links is no hot spot. Links to
    oneself and null ends are ignored; no links give no rows.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    # two steps towards the smallest neighbour fold most of a dense group into one node
    ends = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    step = written(ends.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("to")), "steps")
    onward = step.select(F.col("a").alias("to"), F.col("to").alias("next"))
    steps = written(step.join(onward, "to").select(F.col("a").alias("node"), F.col("next").alias("folded")), "steps")
    one = edges.join(steps, F.col("a") == F.col("node")).select(F.col("folded").alias("a"), "b")
    both = one.join(steps, F.col("b") == F.col("node")).select("a", F.col("folded").alias("b"))
    edges = written(
        both.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while not _are_stars(edges):
        edges = written(_small_star(_large_star(edges)), "links")
    roots = edges.select("a", F.col("b").alias("root"))
    return steps.join(roots, F.col("folded") == F.col("a"), "left").select(
        "node", F.coalesce("root", "folded").alias("component")
    )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is linked to one smaller node, which itself is linked to none."""
    several = edges.groupBy("a").agg(F.count("*").alias("n")).where("n > 1")
    if several.limit(1).count():
        return False
    inner = edges.select(F.col("b").alias("a")).distinct().join(edges.select("a"), "a", "left_semi")
    return not inner.limit(1).count()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    least = written(least, "least")
    return (
        both.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).distinct()
