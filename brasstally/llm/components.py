"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brasstally.llm.common import written


def forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's edges as (node, smallest node that it is joined to here)."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for pdf in batches:
        for a, b in zip(pdf["a"].tolist(), pdf["b"].tolist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    rows = [(x, root(x)) for x in parent if root(x) != x]
    for at in range(0, len(rows), 100_000):
        yield pd.DataFrame(rows[at : at + 100_000], columns=["a", "b"])


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node joins the smallest of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours join the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) of every node that has an edge; a component is named by its smallest node.

    ``edges`` has columns ``a`` and ``b`` of one ordered type, without nulls; direction,
    repeats and loops do not matter. Each task first reduces its own edges to a forest,
    so that long chains shorten; then stars alternate until nothing changes. Edges of a
    node with very many neighbours are joined by Spark's skewed join, their smallest
    neighbour is found with partial aggregates. Every round is written.
    """
    kind = edges.schema["a"].dataType.simpleString()
    stars = written(edges.where("a <> b").mapInPandas(forest, f"a {kind}, b {kind}"), "edges")
    seen = None
    while True:
        stars = written(small_star(large_star(stars)), "stars")
        state = stars.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == seen or not state[0]:
            break
        seen = state
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
