"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.staging import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label) for every id on an edge; ``label`` is the smallest id of its component.

    Each round takes the smallest label among neighbours and then the label of that label, so that the number of
    rounds grows with the logarithm of the longest path in practice. Rounds are written to the shared folder, which
    cuts the lineage. Neighbours are reduced by a mergeable minimum: a busy id is no busy task.
    """
    there, back = edges.select(F.col(a).alias("id"), F.col(b).alias("to")), edges.select(F.col(b).alias("id"), F.col(a).alias("to"))
    both = written(there.union(back).distinct(), "edges")
    labels = written(both.groupBy("id").agg(F.least("id", F.min("to")).alias("label")), "labels")
    while True:
        nearest = both.join(labels.withColumnRenamed("id", "to").hint("merge"), "to").groupBy("id")
        lower = labels.withColumnRenamed("label", "old").join(nearest.agg(F.min("label").alias("near")), "id")
        lower = lower.select("id", "old", F.least("old", "near").alias("label"))
        target = labels.select(F.col("id").alias("label"), F.col("label").alias("next"))
        jumped = lower.join(target.hint("merge"), "label").select("id", "old", F.least("label", "next").alias("label"))
        table = written(jumped, "labels")
        labels = table.select("id", "label")
        if table.where("old <> label").isEmpty():
            return labels
