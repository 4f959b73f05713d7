"""Connected components of a distributed graph, by DataFrame operations only."""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import sent_if_small
from tripmart.session import delete_folder, scratch_dir, temporary

#: Nodes with so many neighbours are joined by sending them to all tasks, if their table is small.
HUB = 1024


def _with_lowest(edges: DataFrame, kept: ExitStack) -> DataFrame:
    """``a, b, low``: each edge with the lowest of the neighbours of ``a``.

    The rows of a hub would all go to one task. Hubs are a small part of the nodes, one per ``HUB`` edges at
    most, so their rows stay where they are and the others are joined by a shuffle.
    """
    lowest = edges.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
    lowest = kept.enter_context(temporary(lowest, "lowest"))
    if (lowest.agg(F.max("n")).first()[0] or 0) < HUB:
        return edges.join(lowest.select("a", "low"), "a")
    hubs = sent_if_small(lowest.filter(F.col("n") >= HUB).select("a", "low"), F.lit(16))
    others = lowest.filter(F.col("n") < HUB).select("a", "low")
    return edges.join(hubs.select("a"), "a", "left_anti").join(others, "a").unionByName(edges.join(hubs, "a"))


def _stars(edges: DataFrame, kept: ExitStack) -> DataFrame:
    """One large-star and one small-star step on edges (a, b) with a > b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    large = _with_lowest(both, kept).filter("b > a").select(F.col("b").alias("a"), F.least("a", "low").alias("b"))
    large = kept.enter_context(temporary(large.filter("a > b").distinct(), "large-star"))
    linked = _with_lowest(large, kept)
    return (
        linked.select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b")).filter("a > b").distinct()
    )


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node, root`` for every node that has an edge to another one; the root is the smallest node.

    Distributed union-find by alternating stars: every node is linked to the lowest of its
    neighbours until all components are stars, in a number of rounds that grows with the logarithm
    of a component's length. Rows are edges, never groups: a component with a third of all nodes is
    many rows of one key, which are pre-aggregated to a minimum and joined without a shuffle of the key (see ``HUB``).
    Each round is written to the shared folder, and the one before it deleted. Null nodes and loops are left out,
    repeated edges count once, and no edges give no rows.
    """
    spark, a, b = edges.sparkSession, F.col(left), F.col(right)
    found = edges.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    state, path = None, None
    while True:
        with ExitStack() as kept:
            before, path = path, scratch_dir(spark, "edges")
            (found if before is None else _stars(found, kept)).write.parquet(path)
            found = spark.read.schema(found.schema).parquet(path)
        if before is not None:
            delete_folder(spark, before)
        total = found.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if total == state or not total["n"]:
            return found.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                found.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = total
