"""Connected components of a link table, by repeated hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def saved(df: DataFrame, path: str, parts: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there (lineage ends).
    At most ``parts`` tasks write, if given, each as many of the partitions."""
    (df if parts is None else df.coalesce(parts)).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected(links: DataFrame, path: str, parts: int | None = None) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the label is the same
    for all nodes of a component.  Each step hooks a node to its smallest
    neighbour, shortens the pointers once, and contracts the links; the nodes
    left at least halve, so there are about log2(nodes) steps.  All minima
    are combined before the shuffle; nothing is gathered by component.  Tables
    are written in at most ``parts`` files, if given."""
    edges, steps = links.select("a", "b").filter("a <> b"), []
    while not steps or not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select(
            "node", F.least("node", "near").alias("up"))
        above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
        step = saved(parent.join(above, "up").select("node", F.col("top").alias("label")), f"{path}/step{len(steps)}", parts)
        for end in ("a", "b"):
            edges = edges.join(step.withColumnRenamed("node", end), end).drop(end).withColumnRenamed("label", end)
        edges = saved(edges.select("a", "b").filter("a <> b"), f"{path}/edges{len(steps)}", parts)
        steps.append(step)
    labels = steps[0]
    for step in steps[1:]:
        nxt = step.select(F.col("node").alias("label"), F.col("label").alias("then"))
        labels = labels.join(nxt, "label", "left").select("node", F.coalesce("then", "label").alias("label"))
    return labels
