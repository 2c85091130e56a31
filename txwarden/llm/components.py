"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwarden.llm.tables import settled


def connected_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Bring ``labels`` (node, label) up to date with ``links`` (a, b): nodes have one label if and
    only if links connect them, the smallest one. Every pass takes the smallest label among a
    component's neighbours for whole components at once, then follows labels of labels, so
    long chains shorten geometrically. Nothing is collected; hot nodes are combined before the shuffle."""
    named = lambda side: labels.select(F.col("node").alias(side), F.col("label").alias(f"l{side}"))
    edges = links.join(named("a"), "a").join(named("b"), "b").select("la", "lb").filter("la != lb")
    edges = settled(edges.distinct(), "edges")
    roots = edges.select(F.col("la").alias("root")).union(edges.select("lb")).distinct()
    parent = settled(roots.select("root", F.col("root").alias("to")), "roots")
    while not edges.isEmpty():
        both = edges.select(F.col("la").alias("x"), F.col("lb").alias("y")).union(edges.select("lb", "la"))
        least = both.groupBy("x").agg(F.min("y").alias("y"))
        least = least.select("x", F.least("x", "y").alias("y"))
        for _ in range(2):  # labels of labels
            up = least.select(F.col("x").alias("y"), F.col("y").alias("z"))
            least = least.join(up, "y", "left").select("x", F.coalesce("z", "y").alias("y"))
        least = settled(least, "least")
        moved = parent.join(least, parent["to"] == least["x"], "left")
        parent = settled(moved.select("root", F.coalesce("y", "to").alias("to")), "parents")
        one = least.select(F.col("x").alias("la"), F.col("y").alias("na"))
        two = least.select(F.col("x").alias("lb"), F.col("y").alias("nb"))
        left = edges.join(one, "la").join(two, "lb").select(F.col("na").alias("la"), F.col("nb").alias("lb"))
        edges = settled(left.filter("la != lb").distinct(), "edges")
    out = labels.join(parent, labels["label"] == parent["root"], "left")
    return settled(out.select("node", F.coalesce("to", "label").alias("label")), "labels")
