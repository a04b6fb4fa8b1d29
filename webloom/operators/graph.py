"""Breadth-first depths over a link graph."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reliable(df: DataFrame) -> DataFrame:
    """df with its lineage cut through the shared checkpoint folder (one of our own only where none is set and all runs on one machine)."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = context.getConf().get("spark.checkpoint.dir")
        if not named and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
        context.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="webloom-"))
    return df.checkpoint(eager=True)


def bfs_depths(edges: DataFrame, seeds: DataFrame, max_depth: int, src: str = "src", dst: str = "dst", node: str = "node") -> DataFrame:
    """(node, depth): the least number of links from a seed, up to max_depth.

    One join a level: the frontier with the edges, pre-aggregated, less what was seen. The level's lineage is cut, so that a
    lost executor costs one level."""
    links = edges.select(F.col(src).alias("__src"), F.col(dst).alias("__dst")).distinct()
    frontier = seeds.select(F.col(node)).where(F.col(node).isNotNull()).distinct().withColumn("depth", F.lit(0))
    seen = frontier = reliable(frontier)
    for level in range(1, max_depth + 1):
        reached = frontier.join(links, F.col(node) == F.col("__src")).select(F.col("__dst").alias(node)).where(F.col(node).isNotNull()).distinct()
        frontier = reliable(reached.join(seen, node, "left_anti").withColumn("depth", F.lit(level)))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen


def crawl(edges: DataFrame, seeds: DataFrame, max_depth: int, max_pages: int) -> DataFrame:
    """(node, depth): breadth-first depths, at most ``max_pages`` nodes, nearest first and then by name."""
    return bfs_depths(edges, seeds, max_depth).orderBy("depth", "node").limit(max_pages)


def assigned_depth(pages: DataFrame, depths: DataFrame, max_depth: int, final: str = "final_url", original: str = "original_url", overflow: str = "clamp") -> DataFrame:
    """pages with ``depth``: by the final URL, else the original one, else 1; over max_depth clamped or dropped."""
    by_final = depths.select(F.col("node").alias("__f"), F.col("depth").alias("__fd"))
    by_original = depths.select(F.col("node").alias("__o"), F.col("depth").alias("__od"))
    both = pages.join(by_final, F.col(final) == F.col("__f"), "left").join(by_original, F.col(original) == F.col("__o"), "left")
    found = both.withColumn("depth", F.coalesce("__fd", "__od", F.lit(1))).drop("__f", "__fd", "__o", "__od")
    if overflow == "drop":
        return found.where(F.col("depth") <= max_depth)
    return found.withColumn("depth", F.least("depth", F.lit(max_depth)))
