"""Connected components of links between 64-bit ids, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tileplan.llm.tables import written


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every id of ``links`` (a, b); the label is the smallest id reachable.

    Each round takes the smallest label among an id's neighbours and then the label of that label, so chains halve.
    An id with many links is reduced before the shuffle, and its rows in the joins can be split.
    """
    edges = written(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("_least")).select(
        "id", F.least("id", "_least").alias("label")), "labels")
    while True:
        near = (edges.join(labels, edges["b"] == labels["id"]).groupBy(F.col("a").alias("id"))
                .agg(F.min("label").alias("_near")))
        lower = labels.join(near, "id").select("id", F.col("label").alias("_old"), F.least("label", "_near").alias("_new"))
        of = labels.select(F.col("id").alias("_new"), F.col("label").alias("_further"))
        moved = written(lower.join(of, "_new", "left").select(
            "id", F.least("_new", "_further").alias("label"), "_old"), "labels")
        labels = moved.select("id", "label")
        if not moved.where("label < _old").limit(1).count():
            return labels
