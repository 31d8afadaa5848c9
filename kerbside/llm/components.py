"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kerbside.operators.staging import staged


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``label`` (smallest id reachable) of every id in ``links`` (a, b).

    Labels flow along links and then jump to the label of their label, so long chains take few rounds. A round's
    labels are written to the shared folder; nothing but the number of changes comes to the driver. An id with many
    links is reduced on the map side.
    """
    ends = links.select("a", "b").where(F.col("a") != F.col("b"))
    both = staged(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = staged(
        both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("id"), F.least("a", "low").alias("label"))
    )
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("low"))
        hooked = labels.join(near.withColumnRenamed("a", "id"), "id").select(
            "id", "label", F.least("label", "low").alias("low"))
        over = labels.select(F.col("id").alias("low"), F.col("label").alias("far"))
        following = staged(hooked.join(over, "low").select("id", F.least("low", "far").alias("label"), F.col("label").alias("was")))
        changed = following.where(F.col("label") != F.col("was")).limit(1).count()
        labels = following.select("id", "label")
        if not changed:
            return labels
