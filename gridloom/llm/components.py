"""Connected components of a table of links, by min-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, spread_join, stored


def connected(links: DataFrame) -> DataFrame:
    """(id, component) of every end of a link (a, b); the component is its smallest id.

    Each round every id takes the smallest label of its neighbours and then that label's own label, so paths shorten
    by more than half. Labels are aggregated before the shuffle and the joins spread ids with a great many links and
    components with a great many ids. Each round is a written table, and the one before goes; only a count of changes
    comes to the driver.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = spread_join(both, labels.withColumnRenamed("id", "b"), "b", by="a").groupBy("a").agg(F.min("component").alias("near"))
        lowered = stored(labels.join(near, F.col("id") == F.col("a"), "left").select(
            "id", F.col("component").alias("was"), F.least("component", "near").alias("component")
        ), "labels")
        above = lowered.select(F.col("id").alias("component"), F.col("component").alias("above"))  # every component is an id
        jumped = stored(spread_join(lowered, above, "component", by="id").select("id", "was", F.least("component", "above").alias("component")), "labels")
        changed = jumped.where("component <> was").limit(1).count()
        discard(labels, lowered)
        labels = jumped
        if not changed:
            discard(both)
            return labels.select("id", "component")
