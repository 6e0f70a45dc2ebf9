"""Connected components by joins: no link, label or component is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import written


def connected_components(links: DataFrame) -> DataFrame:
    """`node, label` for `links(a, b)`; the label is the smallest node of the component.

    Each round gives a node the smallest label among its neighbours, then the label of that label, and is written to the
    shared folder. It ends when no label changes.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")), "labels")
    while True:
        heard = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard"))
        nearer = labels.join(heard, "node", "left").select("node", F.col("label").alias("old"), F.least("label", F.coalesce("heard", "label")).alias("label"))
        owner = labels.select(F.col("node").alias("owner"), F.col("label").alias("of_owner"))
        jumped = nearer.join(owner, nearer["label"] == owner["owner"], "left")
        rounds = written(jumped.select("node", "old", F.least("label", F.coalesce("of_owner", "label")).alias("label")), "labels")
        labels = rounds.select("node", "label")
        if rounds.filter("old <> label").isEmpty():
            return labels
