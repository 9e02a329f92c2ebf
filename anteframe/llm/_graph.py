"""Connected components of links between ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import stored


def components(links: DataFrame) -> DataFrame:
    """Smallest id reachable from each id in ``links`` (a, b): columns id, component_id.

    Each round takes the smallest label among neighbours and then the label of that label, so
    chains shrink by at least half. Labels meet links by equality joins, which the engine splits
    where one id has very many links, and minima are merged before they move. No links: no rows.
    """
    both = stored(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct()
    )
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").select(F.col("a").alias("id"), "label")
        least = near.unionByName(labels).groupBy("id").agg(F.min("label").alias("label"))
        far = labels.select(F.col("id").alias("label"), F.col("label").alias("far"))
        grown = stored(least.join(far, "label").select("id", F.least("label", "far").alias("label")))
        if not labels.join(grown.withColumnRenamed("label", "now"), "id").where("label != now").limit(1).count():
            return grown.withColumnRenamed("label", "component_id")
        labels = grown
