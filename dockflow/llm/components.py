"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import settle


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, root) for every node of an edge table (a, b); the root is the smallest node of the component.

    Stars are contracted in turns: every node hands its larger neighbours to its smallest one, then its smaller ones,
    until nothing changes. A round is two aggregates and two joins over the edges, written to the shared folder, so a
    node with very many edges is never gathered in one place. Rounds grow with the logarithm of the longest path.
    """
    now = settle(
        edges.filter("a != b").select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")).distinct(), f"{label}-edges"
    )
    while True:
        both = now.select(F.col("child").alias("u"), F.col("parent").alias("v")).unionAll(
            now.select(F.col("parent").alias("u"), F.col("child").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u and v != m").select(F.col("v").alias("child"), F.col("m").alias("parent")).distinct()
        large = settle(large, f"{label}-large")
        lowest = large.groupBy("child").agg(F.min("parent").alias("m"))
        small = (
            large.join(lowest, "child")
            .select("child", "parent", "m")
            .select(F.explode(F.array(F.struct(F.col("child").alias("child"), F.col("m").alias("parent")), F.struct(F.col("parent").alias("child"), F.col("m").alias("parent")))).alias("e"))
            .select("e.*")
            .filter("child != parent")
            .distinct()
        )
        small = settle(small, f"{label}-small")
        if small.exceptAll(now).isEmpty() and now.exceptAll(small).isEmpty():
            break
        now = small
    return small.select(F.col("child").alias("node"), F.col("parent").alias("root")).unionAll(
        small.select(F.col("parent").alias("node"), F.col("parent").alias("root")).distinct()
    )
