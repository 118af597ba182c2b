"""Connected components of a link table by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import Scratch


def connected(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Links (a, b) of longs -> (node, root): the smallest node reachable, for every node with a link to another one.

    Both steps are a grouped minimum and a join back, so no node's neighbours are ever gathered in one task.
    Each round is cut with a written table, and so is the result; tables of earlier rounds are removed. Repeated links, self links and both directions are allowed.
    """
    size = lambda e: tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
    scratch = Scratch(links.sparkSession)
    edges = scratch.write(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = size(edges)
    for _ in range(most_rounds):
        if not before[0]:
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.*")
        edges = scratch.write(small.where("a <> b").distinct(), "links")
        scratch.drop("links", keep_last=True)
        after = size(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = scratch.write(nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()), "roots")
    scratch.drop("links")
    return roots
