"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txsieve.session import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links (a, b)``; nodes have equal labels if links connect them.

    Each round sends every node to the smallest neighbour of its smallest
    neighbour and keeps the links between different targets. The links shrink
    at least geometrically, so there are few rounds; each is written, so lost
    executors cost no more than a round.
    """
    rounds: list[DataFrame] = []
    links = materialize(links.where("a != b"), "links")
    while links.head(1):
        both = links.union(links.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("to")
        )
        hooks = materialize(hooks, "hooks")
        onward = hooks.select(F.col("node").alias("to"), F.col("to").alias("then"))
        targets = materialize(hooks.join(onward, "to").select("node", F.col("then").alias("to")), "targets")
        rounds.append(targets)
        links = materialize(
            links.join(targets.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(targets.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .where("x != y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "links",
        )
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = rounds[0].select("node", F.col("to").alias("label"))
    for later in rounds[1:]:
        labels = (
            labels.join(later.select(F.col("node").alias("label"), "to"), "label", "left")
            .select("node", F.coalesce("to", "label").alias("label"))
        )
    return labels
