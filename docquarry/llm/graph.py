"""Connected components of an undirected graph, without bringing it together."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docquarry.llm.common import written

#: Rounds after which a longer chain counts as an error rather than going on.
MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node of it) for all nodes that
    ``edges`` (columns ``a``, ``b`` of one type) names.

    Each round every node takes the least label around it, and then the label
    of its label, so that paths shrink by half.  Sums per node are partial
    minima, so a node with very many edges is no burden; its join is left to
    the skew handling of adaptive execution.  The labels of each round are
    written, so the plan stays short and survives lost executors.  Null ends,
    loops and repeated edges change nothing.
    """
    given = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    both = written(given.unionByName(given.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "graph-edges")
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "node"), "graph-labels")
    for _ in range(MOST_ROUNDS):
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("least"))
        nearer = written(
            labels.join(around, labels["node"] == around["a"]).select(
                "node", F.least("component", "least").alias("component"), F.col("component").alias("was")
            ),
            "graph-near",
        )
        jump = nearer.select(F.col("node").alias("at"), F.col("component").alias("far"))
        labels = written(
            nearer.join(jump, nearer["component"] == jump["at"]).select("node", F.least("component", "far").alias("component"), "was"), "graph-labels"
        )
        if not labels.where("component <> was").limit(1).count():
            return labels.select("node", "component")
        labels = labels.select("node", "component")
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")


def star_components(stars: DataFrame) -> DataFrame:
    """``node`` and ``component`` for all nodes of ``stars``, whose rows tie a
    ``node`` to a ``center``; every center must have a row with itself, too.

    Before anything is joined, each node falls to its least center, and only the
    different pairs of a least and another center go on: many nodes that share
    their centers become a few edges.  Rows with a null change nothing.
    """
    given = stars.select("node", "center").where("node IS NOT NULL AND center IS NOT NULL")
    fallen = written(given.withColumn("least", F.min("center").over(Window.partitionBy("node"))).distinct(), "graph-fallen")
    found = components(fallen.where("least <> center").select(F.col("least").alias("a"), F.col("center").alias("b")).distinct())
    ends = found.select(F.col("node").alias("at"), F.col("component").alias("end"))
    labels = fallen.select("node", "least").distinct()
    return labels.join(ends, labels["least"] == ends["at"], "left").select("node", F.coalesce("end", "least").alias("component"))
