"""Connected components of a distributed edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.rows import written


def components(edges: DataFrame) -> DataFrame:
    """Edges (a long, b long) -> (node, root): one root for each component; nodes without an edge don't appear.

    Each round every node chooses the least of itself and its neighbours, and the edges are carried over to
    the chosen nodes.  Even rounds compare the nodes themselves, which folds a star in one round; odd rounds
    compare fresh hashes, which shrinks even a long chain by a constant factor on average.  The edge
    table and the choices stay distributed; the driver only asks whether edges are left.
    """
    left = written(_distinct(edges.select("a", "b")))
    choices: list[DataFrame] = []
    while not left.isEmpty():
        turn = len(choices)
        order = (lambda c: F.xxhash64(F.lit(turn), c)) if turn % 2 else (lambda c: c)  # noqa: B023
        both = left.select(F.col("a").alias("u"), F.col("b").alias("v")).union(left.select("b", "a"))
        least = both.groupBy("u").agg(F.min(F.struct(order(F.col("v")).alias("k"), F.col("v"))).alias("m"))
        own = F.struct(order(F.col("u")).alias("k"), F.col("u").alias("v"))
        choice = written(least.select("u", F.least(own, F.col("m")).getField("v").alias("to")))
        choices.append(choice)
        from_a, from_b = (choice.select(F.col("u").alias(x), F.col("to").alias(f"to_{x}")) for x in "ab")
        moved = left.join(from_a, "a").join(from_b, "b").select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))
        left = written(_distinct(moved))
    if not choices:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).filter(F.lit(False))
    roots = choices[0].select(F.col("u").alias("node"), F.col("to").alias("root"))
    for choice in choices[1:]:
        step = choice.select(F.col("u").alias("root"), "to")
        roots = roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return roots


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
