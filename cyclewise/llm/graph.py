"""Connected components of a link table by large-star / small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclewise.llm.common import cut_lineage


def components(links: DataFrame, name: str = "cc") -> DataFrame:
    """``links``: (a, b) of longs -> (node, component) for every linked node, the component being its smallest node.

    Each round is two aggregates with map-side minima and two joins; it is written to the shared folder.  Rounds
    end when a round changes nothing.
    """
    edges = cut_lineage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), name
    )
    seen = None
    while True:
        # large star: a node's larger neighbours go to its smallest neighbour (itself included)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, F.col("u") == F.col("n")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), "m")
        small = large.join(least, F.col("u") == F.col("n")).select("v", "m").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.union(least.select("n", "m")).distinct(), name)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
            ).distinct()
        seen = tuple(state)
