"""Connected components of a link table, by label propagation with pointer
jumping. Every round is written to the shared folder, so plans stay short and
a lost executor costs one round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benelake.llm.tables import written


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``label`` (the smallest id that its links reach) for every id
    in links (a, b). Self links and repeated links do no harm; nulls are left
    out."""
    links = links.where("a is not null and b is not null and a <> b").select("a", "b")
    both = written(links.union(links.select(F.col("b"), F.col("a"))).distinct())
    labels = written(both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("id"), F.least("a", "least").alias("label")))
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels["id"] == near["a"]).select("id", F.least("label", "near").alias("next"), F.col("label").alias("old"))
        target = lower.select(F.col("id").alias("at"), F.col("next").alias("jump"))
        moved = lower.join(target, lower["next"] == target["at"], "left")
        labels = written(moved.select("id", F.least("next", F.coalesce("jump", "next")).alias("label"), "old"))
        if labels.where("label <> old").limit(1).count() == 0:
            return labels.select("id", "label")
        labels = labels.select("id", "label")
