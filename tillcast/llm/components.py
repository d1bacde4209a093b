"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.session import settled


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long); root is the smallest node reachable.

    Each round points every node at its smallest neighbour, follows the pointers to their ends by
    doubling, and replaces the nodes of the links by those ends. Links inside one end vanish, so
    the table shrinks until none is left. Nothing is gathered by node: minima are partial sums and
    joins with a node of many links are split like any skewed join. All steps are stored, so a
    lost executor costs the running step. An empty table gives an empty result; repeated links,
    links both ways and links of a node with itself do no harm.
    """
    spark = links.sparkSession
    edges = settled(links.where("a <> b").select("a", "b"))
    found = spark.createDataFrame([], "node long, root long")
    first = True
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = settled(
            both.groupBy("a")
            .agg(F.min("b").alias("least"))
            .select(F.col("a").alias("node"), F.least("a", "least").alias("root"))
        )
        up = _ends(up)
        if first:
            found, first = up, False
        else:
            step = up.select(F.col("node").alias("root"), F.col("root").alias("end"))
            found = settled(
                found.join(step, "root", "left").select(
                    "node", F.coalesce("end", "root").alias("root")
                )
            )
        a = up.select(F.col("node").alias("a"), F.col("root").alias("a_end"))
        b = up.select(F.col("node").alias("b"), F.col("root").alias("b_end"))
        edges = settled(
            edges.join(a, "a")
            .join(b, "b")
            .where("a_end <> b_end")
            .select(F.col("a_end").alias("a"), F.col("b_end").alias("b"))
            .distinct()
        )
    return found


def _ends(up: DataFrame) -> DataFrame:
    """Follow each node's pointer to its end; pointers only go down, so there is one."""
    while True:
        above = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = settled(
            up.join(above, "root", "left").select(
                "node", F.coalesce("next", "root").alias("root"), F.col("root").alias("was")
            )
        )
        up = moved.select("node", "root")
        if moved.where("root <> was").isEmpty():
            return up
