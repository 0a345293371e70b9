"""Connected components of a link table by alternating stars.

Each round first points every node's larger neighbours at the smallest
neighbour, then its smaller ones; what remains are stars around the smallest
node of each component. A round is two groupings and two joins on the node, no
node's neighbours are ever held together, and each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeloom.llm.common import stored


def _both(links: DataFrame) -> DataFrame:
    """Each link from both ends."""
    ends = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    return links.select(F.inline(ends)).where("u != v")


def _large(links: DataFrame) -> DataFrame:
    both = _both(links)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return (
        moved.select(F.inline(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))))
        .where("a != b")
        .distinct()
    )


def _print(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; ``links`` has columns a and b, in any order, also repeated.

    The root is the smallest node of the component. Links of a node with
    itself and links with null are ignored. An empty table gives an empty one.
    """
    now = stored(links.select("a", "b").where("a != b").distinct(), "links")
    seen = _print(now)
    while seen[0]:
        now = stored(_small(_large(now)), "links")
        found = _print(now)
        if found == seen:
            break
        seen = found
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
