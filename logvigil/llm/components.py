"""Connected components of a graph given as pairs of longs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logvigil.llm.common import stored


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node reachable.

    Each round sends a node to its smallest neighbour, follows that twice, and joins the
    nodes that have met into one. Every round is written to the shared folder, so a lost executor costs
    at most one round. The driver learns only whether links are left. Self-links are fine.
    """
    spark = links.sparkSession
    links = stored(links.select(F.col("a").cast("long"), F.col("b").cast("long")), folder, "links-0")
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    labels = stored(nodes.withColumn("root", F.col("node")), folder, "labels-0")
    links = links.filter("a <> b")
    step = 0
    while not links.isEmpty():
        step += 1
        both = links.union(links.select("b", "a"))
        parent = stored(
            both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("p")),
            folder,
            f"parent-{step}",
        )
        up = parent.select(F.col("a").alias("p"), F.col("p").alias("q"))
        for hop in (1, 2):
            parent = stored(
                parent.join(up, "p", "left").select("a", F.coalesce("q", "p").alias("p")),
                folder,
                f"parent-{step}-{hop}",
            )
        to_a, to_b = parent.select("a", F.col("p").alias("x")), parent.select(F.col("a").alias("b"), F.col("p").alias("y"))
        links = stored(
            links.join(to_a, "a").join(to_b, "b").filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            folder,
            f"links-{step}",
        )
        labels = stored(
            labels.join(parent.select(F.col("a").alias("root"), "p"), "root", "left")
            .select("node", F.coalesce("p", "root").alias("root")),
            folder,
            f"labels-{step}",
        )
    return labels
