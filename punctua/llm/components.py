"""Connected components of a table of links, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.shared import keep


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every end of ``links(a, b)``: the least node it can reach.

    Each round takes the least label among the neighbours and then that label's own label, so
    the rounds grow with the logarithm of a component's width. Every round is a stored table; a
    hot node is split by the skew join. Links to itself and repeated links change nothing.
    """
    both = keep(
        links.select("a", "b").union(links.select("b", "a")).distinct(), "links"
    )
    labels = keep(
        both.groupBy("a").agg(F.min("b").alias("least")).select(
            F.col("a").alias("node"), F.least("a", "least").alias("component")
        ), "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy("a").agg(F.min("component").alias("near"))
        )
        seen = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("mid")
        )
        jump = labels.select(F.col("node").alias("mid"), F.col("component").alias("far"))
        moved = keep(
            seen.join(jump, "mid").select(
                "node", F.least("mid", "far").alias("component"),
                (F.least("mid", "far") != F.col("old")).alias("moved"),
            ), "labels",
        )
        labels = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return labels
