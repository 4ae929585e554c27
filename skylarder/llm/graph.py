"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skylarder.session import shared_dir


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, label (the smallest node of its component) for every node with a link.

    Each round takes the smallest label among neighbours and then the label of that label;
    rounds are stored in the shared folder, so lineage doesn't grow.
    """
    spark = links.sparkSession
    base = shared_dir(spark, "components")
    one = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    both = one.union(one.select("other", "node"))
    both.write.parquet(f"{base}/links")
    both = spark.read.parquet(f"{base}/links")
    first = both.groupBy("node").agg(F.min("other").alias("label")).select("node", F.least("node", "label").alias("label"))
    first.write.parquet(f"{base}/0")
    step = 0
    while True:
        labels = spark.read.schema(first.schema).parquet(f"{base}/{step}")
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("label").alias("near"))
        moved = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        of_label = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        # roots have themselves as label and a row of their own
        jumped = moved.join(of_label, "label", "left").select(
            "node", F.least("label", F.coalesce("further", "label")).alias("label"), "was"
        )
        step += 1
        jumped.write.parquet(f"{base}/{step}")
        if spark.read.schema(jumped.schema).parquet(f"{base}/{step}").where("label <> was").isEmpty():
            return labels
