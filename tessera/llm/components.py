"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, if_few

#: Labels that are broadcast at most; joins with more are left to shuffles and the skew join.
FEW_LABELS = 200_000


def components(links: DataFrame, values: DataFrame | None = None) -> DataFrame:
    """The least node reachable from each node that has a link: node, component. `links` has columns a and b.

    With `values` (node, value), the component is the reachable node of the least value (null last, then the least
    node), and a column `value` has that value.

    Each round takes the least label among a node and its neighbours and then the label of that label, so labels
    cross long chains in few rounds. Every round is written to the checkpoint folder; nothing is collected but
    whether a label still changed.
    """
    both = links.filter("a <> b").select("a", "b")
    both = cut(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    nodes = both.select(F.col("a").alias("node")).distinct()
    if values is None:
        labels = nodes.select("node", F.struct(F.col("node").alias("top")).alias("label"))
    else:
        order = F.struct(F.col("value").isNull().alias("none"), "value", F.col("node").alias("top"))
        labels = values.join(nodes, "node", "left_semi").select("node", order.alias("label"))
    labels = cut(labels)
    while True:
        known = if_few(labels, FEW_LABELS)
        near = both.join(known, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        lower = cut(
            labels.join(near, F.col("node") == F.col("a")).select(
                "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
            )
        )
        jump = lower.select(F.col("node").alias("via"), F.col("label").alias("further"))
        nxt = cut(
            lower.join(if_few(jump, FEW_LABELS), F.col("label.top") == F.col("via")).select(
                "node", "old", F.least("label", "further").alias("label")
            )
        )
        labels = nxt.select("node", "label")
        if nxt.filter("old <> label").isEmpty():
            columns = ["label.value"] if values is not None else []
            return labels.select("node", F.col("label.top").alias("component"), *columns)
