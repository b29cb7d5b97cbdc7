"""Connected components by minimum labels and pointer jumping, round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.session import stage_table


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id of ``links`` (a, b); component: the smallest id.

    Each round a node takes the smallest label among its own and its neighbours',
    then that label's own label. Stars, which leader rounds produce, end after two
    rounds, paths after a number that grows with the logarithm of their length.
    Labels are summed up inside tasks before they are shuffled, and every round
    ends in a staged table, so nothing is recomputed from the start.
    """
    edges = stage_table(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))),
        "edges",
    )
    labels = edges.groupBy("a").agg(F.min("b").alias("near")).select(
        F.col("a").alias("id"), F.least("a", "near").alias("component")
    )
    turn = 0
    while True:
        near = (
            edges.join(labels.select(F.col("id").alias("b"), "component"), "b")
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        # A node moves with the label it had, so that whole trees merge.
        moved = labels.join(near, labels["id"] == near["a"]).select(
            "id", "component", F.least("component", "near").alias("best")
        )
        roots = moved.groupBy(F.col("component").alias("root")).agg(F.min("best").alias("to"))
        now = stage_table(
            moved.join(roots, moved["component"] == roots["root"]).select("id", "component", "to"),
            f"labels-{turn}",
        )
        turn += 1
        if now.where("to != component").limit(1).count() == 0:
            return now.select("id", "component")
        # One jump: the label of the label, where that is known.
        jump = now.select(F.col("id").alias("to"), F.col("to").alias("far"))
        labels = now.join(jump, "to", "left").select(
            "id", F.coalesce("far", "to").alias("component")
        )
