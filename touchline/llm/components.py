"""Connected components of a link table, by distributed label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import write_scratch


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links`` (columns ``a`` and ``b``);
    ``root`` is the least node of its component.  Each round is written to the
    shared folder; only the number of changed labels reaches the driver."""
    links = links.filter("a <> b")
    both = write_scratch(links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = write_scratch(both.groupBy("a").agg(F.min("b").alias("least"))
                           .select(F.col("a").alias("node"), F.least("a", "least").alias("root")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("near")))
        step = labels.join(near, labels["node"] == near["a"]).select("node", "root", F.least("root", "near").alias("next"))
        jump = labels.select(F.col("node").alias("at"), F.col("root").alias("beyond"))
        step = write_scratch(step.join(jump, step["next"] == jump["at"], "left")
                             .select("node", "root", F.least("next", "beyond").alias("next")), "labels")
        labels = step.select("node", F.col("next").alias("root"))
        if step.filter("root <> next").isEmpty():
            return labels
