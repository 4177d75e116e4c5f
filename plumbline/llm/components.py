"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.shared import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: every vertex hands its smallest neighbour on.

    The large step rewires the neighbours above a vertex, the small step those
    below it. Minima combine before the shuffle, and the join that follows has
    no aggregate above it, so AQE may split a hub.
    """
    if large:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
    else:
        sides = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = sides.join(least, "u")
    if large:
        return joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return joined.where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(
        least.where("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b"))
    )


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) for each end of ``edges`` (a, b), component the smallest node.

    Alternating large-star and small-star steps until the edges stand still,
    which takes about log2 of the longest path. Loops and repeated edges do no
    harm; no edges give no rows. Each round is a table in the shared folder.
    """
    state, last = stored(edges.where("a <> b").distinct(), f"{name}-edges"), None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == last or mark[0] == 0:
            break
        last = mark
        state = stored(_star(_star(state, True), False).distinct(), f"{name}-round")
    stars = state.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(state.select(F.col("b"), F.col("b"))).distinct()
