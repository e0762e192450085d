"""Connected components of an undirected graph given as edge rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fallowlens.llm.common import discard, stored, stored_at


def components(edges: DataFrame) -> DataFrame:
    """(id, label) for every node of ``edges`` (a, b): the smallest node it is connected with.

    Each round takes the smallest label among a node and its neighbours, then that
    label's own label, so labels travel twice as far each round. Rounds are stored in
    the shared folder, each until the next one is, and end when no label changes.
    """
    spark = edges.sparkSession
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "graph-edges")
    labels, path = stored_at(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label"))
                             .select("id", F.least("id", "label").alias("label")), "graph-labels")
    while True:
        near = (
            both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        )
        moved = labels.join(near, labels["id"] == near["a"]).select(
            "id", F.col("label").alias("old"), F.least("label", "near").alias("mid")
        )
        target = labels.select(F.col("id").alias("at"), F.col("label").alias("further"))
        before = path
        after, path = stored_at(
            moved.join(target, moved["mid"] == target["at"]).select("id", "old", F.least("mid", "further").alias("label")),
            "graph-labels",
        )
        discard(spark, before)
        labels = after.select("id", "label")
        if after.where("label <> old").isEmpty():
            return labels
