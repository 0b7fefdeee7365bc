"""Connected components of links between ids, by smallest labels and pointer jumping on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.sources.stage import stage


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component): for every id that has a link, the smallest id it can reach. Nothing is collected.

    A round lowers each label to the smallest among neighbours and then to that label's own label, so
    distances halve; it ends when a round changes nothing.
    """
    both = links.select(F.col(a).alias("_from"), F.col(b).alias("_to"))
    edges = stage(both.union(both.select("_to", "_from")).distinct(), "edges")
    labels = stage(edges.groupBy(F.col("_from").alias("id")).agg(F.least(F.col("id"), F.min("_to")).alias("component")), "labels")
    while True:
        seen = edges.join(labels, edges["_to"] == labels["id"]).groupBy("_from").agg(F.min("component").alias("_seen"))
        lowered = (
            labels.join(seen, labels["id"] == seen["_from"])
            .select("id", F.col("component").alias("_old"), F.least("component", "_seen").alias("_low"))
        )
        lowered = stage(lowered, "lowered")
        own = lowered.select(F.col("id").alias("_at"), F.col("_low").alias("_further"))
        jumped = lowered.join(own, lowered["_low"] == own["_at"], "left")
        following = stage(jumped.select("id", F.least("_low", F.coalesce("_further", "_low")).alias("component"), "_old"), "labels")
        if following.where("component <> _old").isEmpty():
            return following.select("id", "component")
        labels = following.select("id", "component")
