"""Connected components of a link table, by label propagation with pointer jumping, wholly in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import dropped, written


def components(links: DataFrame, most: int = 60, alone: bool = False) -> DataFrame:
    """(id, component): each id that occurs in ``links`` (a, b) with the smallest id that it is connected to.
    Links of an id with itself count only with ``alone``.

    A round takes the smallest label among a node and its neighbours, then the label of that label; labels
    only fall and are ids of the same component, so the end is reached when a round changes nothing.  Labels are
    written to the shared folder each round; only one count reaches the driver."""
    links = links.select("a", "b") if alone else links.select("a", "b").where("a <> b")
    both_table = both = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("component")), "labels")
    for _ in range(most):
        near = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("component").alias("m"))
        stepped = labels.join(near, labels.id == near.a).select("id", F.least("component", "m").alias("next"), F.col("component").alias("old"))
        jump = labels.select(F.col("id").alias("at"), F.col("component").alias("beyond"))
        old = labels
        stepped = written(
            stepped.join(jump, stepped.next == jump["at"], "left").select(
                "id", F.least("next", F.coalesce("beyond", "next")).alias("component"), "old",
            ),
            "labels",
        )
        done = stepped.where("component <> old").isEmpty()
        labels = stepped.select("id", "component")
        labels._written = stepped._written
        dropped(labels.sparkSession, old, *[both_table] * done)
        if done:
            return labels
    raise RuntimeError("the labels have not settled")
