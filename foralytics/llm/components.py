"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foralytics.scratch import discard, scratch_path, stage


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): its smallest reachable node.

    Every round each node takes the smallest label around it, hands it to the node
    that its old label names, and follows labels once (so long chains fold up).
    Rounds are written to the shared folder, and a hub is a sum with a map-side
    minimum and a join, never one group in a task. Null ends are left out.
    """
    spark = links.sparkSession
    clean = links.where("a is not null and b is not null and a <> b").select("a", "b")
    both_at, path = scratch_path(spark, "both-ways"), scratch_path(spark, "labels")
    both = stage(clean.unionByName(clean.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "", both_at)
    nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    labels = stage(nearest.select("node", F.least("node", "low").alias("label")), "", path)
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "b", "label": "near"}), "b").groupBy("a").agg(
            F.min("near").alias("near")
        )
        joined = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("low"))
        # The node that the old label names learns of the smaller one.
        told = joined.select(F.explode(F.array("node", "label")).alias("node"), "low").groupBy("node").agg(
            F.min("low").alias("low")
        )
        jumped = told.alias("t").join(told.select(F.col("node").alias("via"), F.col("low").alias("far")).alias("u"), F.col("low") == F.col("via"), "left")
        new = jumped.select("node", F.least("low", F.coalesce("far", "low")).alias("label"))
        next_path = scratch_path(spark, "labels")
        after = stage(new, "", next_path)
        changed = not after.join(labels.withColumnRenamed("label", "old"), "node").where("label <> old").isEmpty()
        discard(spark, path)
        labels, path = after, next_path
        if not changed:
            discard(spark, both_at)
            return labels.select("node", F.col("label").alias("component"))
