"""Connected components of an edge list, in DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainlens.llm.common import stored


def connected_components(edges: DataFrame, distinct: bool = False) -> DataFrame:
    """(node, label) for every node of the edges (a, b): label is one of the
    component's nodes, the same for all of them.

    Every level maps a node to whichever of itself and its neighbours comes
    first in an order drawn anew by hash, and contracts the edges by that map;
    edges inside one image go.  The rest shrinks by a constant factor a level,
    on long paths too, so what is exchanged is little more than the first level.
    The first neighbour is found before the shuffle, so a node with very many
    edges is no hot group.  An empty edge list gives no rows; self loops keep
    their node, repeated edges do no harm.  ``distinct`` says that the edges are a
    stored table without repeats, which is then read as it is."""
    if not distinct:
        edges = stored(edges.select("a", "b").distinct(), "cc-edges")
    maps = []
    while True:
        level = F.lit(len(maps))
        ends = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = F.min(F.struct(F.xxhash64(level, "b").alias("place"), F.col("b").alias("to")))
        own = F.struct(F.xxhash64(level, "node").alias("place"), F.col("node").alias("to"))
        step = ends.groupBy(F.col("a").alias("node")).agg(best.alias("best"))
        step = stored(step.select("node", F.least("best", own).getField("to").alias("to")), "cc-map")
        maps.append(step)
        image = edges.join(step.toDF("a", "x"), "a").join(step.toDF("b", "y"), "b")
        edges = stored(image.where(F.col("x") != F.col("y")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "cc-edges")
        if edges.isEmpty():
            break
    label = maps.pop().select("node", F.col("to").alias("label"))
    for step in reversed(maps):
        further = label.select(F.col("node").alias("to"), "label")
        label = step.join(further, "to", "left").select("node", F.coalesce("label", "to").alias("label"))
    return stored(label, "cc-labels")
