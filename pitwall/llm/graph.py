"""Connected components of a distributed edge table, with DataFrame operations only.

Vertices are fixed-size digests, so that "smallest neighbour" is a random choice: each
round every vertex hooks to the smallest vertex among itself and its neighbours, follows
that pointer once more, and the edges are rewritten to the images.  The vertices that are
left shrink by a constant factor per round, whatever the shape (chains, stars, cliques).
Every round is written to the shared folder; nothing but an emptiness test reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of ``edges`` (columns a, b); self-loops and nulls don't count."""

    def ordered(df: DataFrame) -> DataFrame:
        return (df.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .distinct())

    edges = written(ordered(edges), "edges")
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).unionByName(
            edges.select(F.col("b").alias("v"), F.col("a").alias("w")))
        hook = written(both.groupBy("v").agg(F.min("w").alias("w")).select("v", F.least("v", "w").alias("p")), "hook")
        step = hook.select(F.col("v").alias("p"), F.col("p").alias("root"))
        image = written(hook.join(step, "p").select("v", "root"), "image")
        maps.append(image)
        edges = written(ordered(
            edges.join(image.select(F.col("v").alias("a"), F.col("root").alias("x")), "a")
            .join(image.select(F.col("v").alias("b"), F.col("root").alias("y")), "b")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))), "edges")
    if not maps:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
    out = maps[-1]
    for image in reversed(maps[:-1]):  # v -> image in this round -> root in the later ones
        later = out.select(F.col("v").alias("root"), F.col("root").alias("top"))
        out = image.join(later, "root", "left").select("v", F.coalesce("top", "root").alias("root"))
    return out
