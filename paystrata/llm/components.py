"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import cut


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """Links each node's neighbours to the least of the node and its neighbours.

    ``larger`` sees all neighbours and moves the larger ones; otherwise only smaller
    neighbours, and the node itself, are seen and moved.
    """
    if larger:
        sides = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.min("b").alias("m"))
    # a hub's neighbours are many rows of one key: the join can split them, a group could not
    joined = sides.join(least.withColumn("m", F.least("a", "m")), "a")
    if larger:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            joined.select("a", F.col("m").alias("b"))
        )
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component): each linked node with the least node it can reach.

    Alternates the two star operations until nothing changes; the number of rounds
    grows with the logarithm of the largest component. Only counts reach the driver.
    """
    current = cut(links.select("a", "b").where(F.col("a") != F.col("b")).distinct(), purpose)
    state = None
    while True:
        current = cut(_stars(_stars(current, larger=True), larger=False), purpose)
        row = current.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
        ).first()
        if (row["n"], row["x"]) == state:
            break
        state = row["n"], row["x"]
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
