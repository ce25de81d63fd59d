"""Connected components by alternating large and small stars, all on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a, b), two columns of one orderable type; root is its least node.
    Raises where the last of most_rounds still changed something.

    A round links each node's larger neighbours to its least one, then each node's smaller ones. Every
    half round is written to the shared folder, so the lineage stays short and a lost executor costs
    one half round. The minima are written before they are joined, so that a node with very many
    links is split by Spark's skew join and never gathered in one task.
    """
    now = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.col("u")).alias("m")), "least")
        large = both.join(least, F.col("a") == F.col("u")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "large")
        least = written(large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")), "least")
        small = large.join(least, F.col("a") == F.col("u")).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = written(small.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct(), "small")
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31))).alias("h")).first()
        if seen == tuple(state):
            break
        seen = tuple(state)
    else:
        raise ValueError(f"components still change after {most_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
