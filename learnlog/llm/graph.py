"""Connected components of a link table, by alternating large-star and small-star rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlog.sources.tables import materialize


def _with_least(pairs: DataFrame) -> DataFrame:
    """``(u, v)`` pairs with ``least``, the smallest of u and its partners."""
    least = pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("least"))
    return pairs.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node with a link.

    ``links`` has ``a`` and ``b``, numbers or strings; direction, repeats and loops
    do not matter, and an empty table has no components. A round writes its links
    to the shared folder, which cuts the lineage; rounds end when each node points at
    its component. Minima are combined before the shuffle, and a hot node's links
    are an ordinary skewed join.
    """
    now = materialize(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: partners above u go to the least of u's neighbourhood.
        large = (
            _with_least(both)
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("least").alias("v"))
            .distinct()
        )
        # Small star: partners below u, and u, go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        joined = large.join(least, "u")
        small = (
            joined.select(F.explode(F.array("u", "v")).alias("u"), F.col("least").alias("v"))
            .where("u <> v")
            .distinct()
        )
        after = materialize(small, "links")
        # Done when every node has one link and no node that is pointed at points on.
        nodes = after.select("u").distinct().count()
        roots = after.select(F.col("v").alias("u")).distinct()
        if after.count() == nodes and after.join(roots, "u", "left_semi").isEmpty():
            return after.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                roots.select(F.col("u").alias("node"), F.col("u").alias("component"))
            )
        now = after
