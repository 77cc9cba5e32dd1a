"""Connected components of a table of links, by labels that sink to the smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settled

#: Links, both ways, up to which Spark may broadcast tables of labels. Written ones compress well, so it takes them for too small.
FEW_LINKS = 1 << 17


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with a link; component is the smallest node that can be reached.

    Each round takes the smallest label among a node's neighbours and then the label of that label, so chains
    shorten by doubling. Labels are written once a round; nothing but the count of changes reaches the driver.
    Links with a null end are left out.
    """
    own = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    both = own.select(F.col(a).alias("_from"), F.col(b).alias("_to"))
    both = settled(both.union(both.select("_to", "_from")).distinct())
    # Tables of labels have one row a node, so their files follow the number of links, not the partitions of the session.
    rows = both.count()
    labels = settled(both.groupBy(F.col("_from").alias("node")).agg(F.least(F.min("_to"), F.first("_from")).alias("component")), rows)
    if not rows:
        return labels
    while True:
        labels = labels if rows <= FEW_LINKS else labels.hint("merge")
        seen = both.join(labels.select(F.col("node").alias("_to"), "component"), "_to")
        lower = seen.groupBy(F.col("_from").alias("node")).agg(F.min("component").alias("_near"))
        lower = labels.join(lower, "node").select("node", F.col("component").alias("_was"), F.least("component", "_near").alias("_now"))
        roots = labels.select(F.col("node").alias("_now"), F.col("component").alias("_root"))
        moved = lower.join(roots, "_now").select("node", F.least("_now", "_root").alias("component"), "_was")
        moved = settled(moved, rows)
        labels = moved.select("node", "component")
        if moved.where("component != _was").isEmpty():
            return labels
