"""Connected components of a link table, all on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import join_hot, work_dir, written


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, comp) for every node of ``links`` (a, b) and of the earlier
    ``labels`` (node, comp): comp is the least label of its component, at
    first the node itself where there is no earlier one. Each step takes the
    least label among a node and its neighbours; then all nodes of an old
    label go to the least one that any of them has met, so labels merge by
    whole components. Nodes with very many links are only aggregated or joined
    through ``join_hot``."""
    spark = links.sparkSession
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.distinct(), work_dir(spark, "edges"))
    now = edges.select(F.col("a").alias("node")).distinct()
    now = (now.withColumn("comp", F.col("node")) if labels is None
           else now.join(labels, "node", "full").select("node", F.coalesce("comp", "node").alias("comp")))
    now = written(now, work_dir(spark, "labels"))
    while True:
        near = (join_hot(edges, now.withColumnRenamed("node", "b"), ["b"])
                .groupBy("a").agg(F.min("comp").alias("near")).withColumnRenamed("a", "node"))
        step = now.join(near, "node").groupBy("comp").agg(F.min("near").alias("least")).filter("least < comp")
        moved = written(step, work_dir(spark, "moved"))
        if moved.isEmpty():
            return now
        # a chain of moves is followed to its end two at a time
        twice = moved.select(F.col("comp").alias("least"), F.col("least").alias("next"))
        moved = moved.join(twice, "least", "left").select("comp", F.coalesce("next", "least").alias("least"))
        now = written(join_hot(now, moved, ["comp"], "left").select("node", F.coalesce("least", "comp").alias("comp")),
                      work_dir(spark, "labels"))
