"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.llm.storage import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a`` and ``b``); a component is its smallest node.

    Each round takes the smallest label among neighbours and then that label's own, so labels travel twice as far with
    every round. Rounds end when nothing changes. Every round is a table in the shared folder.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = stored(both.filter("a <> b").distinct(), "edges")
    labels = stored(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        near = (
            edges.join(labels.withColumnsRenamed({"node": "b", "component": "near"}), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("near").alias("near"))
        )
        lower = labels.join(near, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "near").alias("component")
        )
        step = stored(lower, "labels")
        own = step.select(F.col("node").alias("component"), F.col("component").alias("beyond"))
        after = stored(
            step.join(own, "component", "left").select(
                "node", "was", F.least("component", F.coalesce("beyond", "component")).alias("component")
            ),
            "labels",
        )
        labels = after.select("node", "component")
        if after.filter("was <> component").isEmpty():
            return labels


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` of :func:`components` after more ``links``: only components that a link joins are looked at again."""
    if labels is None:
        return components(links)
    if links.isEmpty():
        return labels
    of_a, of_b = (labels.withColumnsRenamed({"node": c, "component": f"_{c}"}) for c in ("a", "b"))
    ends = links.join(of_a, "a", "left").join(of_b, "b", "left")
    ends = stored(ends.select("a", "b", F.coalesce("_a", "a").alias("_a"), F.coalesce("_b", "b").alias("_b")), "ends")
    joined = components(ends.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    joined = joined.withColumnsRenamed({"component": "_root", "node": "component"})
    nodes = labels.union(ends.select("a", "_a")).union(ends.select("b", "_b")).distinct()
    after = nodes.join(joined, "component", "left").select("node", F.coalesce("_root", "component").alias("component"))
    return stored(after, "labels")
