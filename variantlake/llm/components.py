"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantlake.llm.common import written


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of ``links``; the component is its least node.

    Least labels move along the links, and each round every label is replaced by its own
    label, so that distances halve. A round reads and writes tables of nodes and links
    only; neither ever reaches the driver. An empty table gives no rows; a link from a
    node to itself makes a component of one. Null ends are not allowed.
    """
    one_way = links.select(F.col(a).alias("node"), F.col(b).alias("other")).where(F.col(a) != F.col(b))
    both = written(one_way.unionByName(one_way.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "links")
    alone = links.select(F.col(a).alias("node")).unionByName(links.select(F.col(b).alias("node")))
    label = F.least("node", "least")
    labels = written(
        alone.distinct()
        .join(both.groupBy("node").agg(F.min("other").alias("least")), "node", "left")
        .select("node", F.coalesce(label, F.col("node")).alias("component"), F.lit(True).alias("moved")),
        "labels",
    )
    while labels.where("moved").limit(1).count():
        held = labels.select(F.col("node").alias("other"), F.col("component").alias("theirs"))
        around = both.join(held, "other").groupBy("node").agg(F.min("theirs").alias("least"))
        nearer = labels.join(around, "node", "left").select(
            "node", F.col("component").alias("before"), F.coalesce(F.least("component", "least"), F.col("component")).alias("component")
        )
        jump = nearer.select(F.col("node").alias("component"), F.col("component").alias("further"))
        labels = written(
            nearer.join(jump, "component").select(
                "node", F.col("further").alias("component"), (F.col("further") != F.col("before")).alias("moved")
            ),
            "labels",
        )
    return labels.select("node", "component")


def folded(stars: DataFrame, node: str, hub: str) -> DataFrame:
    """Links (node, hub) with the same components as ``stars``, one for each node and few between hubs.

    A node keeps the star of its least hub; the other hubs that it names are linked to that
    hub once, however many nodes name the same two.
    """
    per = stars.groupBy(node).agg(F.min(hub).alias("_least"), F.collect_set(hub).alias("_hubs"))
    per = written(per.select(F.col(node).alias("node"), F.col("_least").alias("hub"), "_hubs"), "folded")
    between = per.select(F.explode("_hubs").alias("node"), "hub").distinct()
    return per.select("node", "hub").unionByName(between)
