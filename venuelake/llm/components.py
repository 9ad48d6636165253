"""Connected components of link tables by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuelake.llm.tables import written


def _least(pairs: DataFrame) -> DataFrame:
    """Rows (u, v) with the least neighbour m of u; written, so that the join can split hot nodes."""
    return written(pairs.groupBy("u").agg(F.min("v").alias("m")), "components-least")


def _is_done(edges: DataFrame) -> bool:
    """Whether every node hangs on one other that hangs on none: the links are stars already."""
    several = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return several.isEmpty() and edges.join(edges.select(F.col("v").alias("u")).distinct(), "u", "left_semi").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """Rows (node, component) of all nodes of ``links`` (a, b): the least node that links lead to.

    Each round hangs every node's larger neighbours below its least one, then its smaller ones
    likewise (large and small star), until only stars are left. Nothing but the question whether
    they are leaves the cluster, and a node of any degree is spread over tasks. Loops and repeated
    links do no harm; links with a null end are left out.
    """
    known = links.where("a is not null and b is not null")
    edges = written(
        known.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "components-links",
    )
    while not _is_done(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = written(
            both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(),
            "components-large",
        )
        joined = large.join(_least(large), "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            joined.select("u", F.col("m").alias("v"))
        )
        edges = written(small.distinct(), "components-small")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
