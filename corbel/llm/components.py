"""Connected components of a graph of links, as joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corbel.llm.common import settle


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of all nodes of ``links`` (``a``, ``b``).

    In each round every label hangs onto the smallest label that a link joins it
    to, chains of labels are followed to their ends, and links are rewritten
    between the labels left; it ends when no link joins two labels. Each round is written, so the
    plan stays small and a lost executor costs one round. Minima are partly
    taken before each shuffle, and adaptive execution can split joins at nodes
    with very many links. Links that are loops or null are left out.
    """
    edges = settle(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a < b")
        .distinct(),
        "links",
    )
    both = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = settle(both.select("node", F.col("node").alias("component")), "labels")
    while True:
        left = labels.select(F.col("node").alias("a"), F.col("component").alias("la"))
        right = labels.select(F.col("node").alias("b"), F.col("component").alias("lb"))
        # Links between labels: those within one label have done their work.
        edges = settle(
            edges.join(left, "a")
            .join(right, "b")
            .where("la != lb")
            .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
            .distinct(),
            "links",
        )
        if edges.isEmpty():
            return labels
        hung = edges.groupBy(F.col("b").alias("component")).agg(F.min("a").alias("onto"))
        hung = settle(hung, "hung")
        while True:  # each label to the end of its chain, in doubling steps
            next_ = hung.select(F.col("component").alias("onto"), F.col("onto").alias("further"))
            hung = settle(hung.join(next_, "onto", "left"), "hung")
            moved = not hung.where("further IS NOT NULL").isEmpty()
            hung = hung.select("component", F.coalesce("further", "onto").alias("onto"))
            if not moved:
                break
        labels = settle(
            labels.join(hung, "component", "left").select(
                "node", F.coalesce("onto", "component").alias("component")
            ),
            "labels",
        )
