"""Streaming query (Z1): continuous intake of ratings."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kiln.plans.registry import query
from kiln.session import scratch_path
from kiln.sources import views as V
from kiln.sources.tables import load
from kiln.streaming.intake import item_stats_stream, latest_ratings_stream, read_latest_stats, read_stats


@query("intake_item_stats", """
SELECT item_id, count(*) AS n, round(sum(rating), 6) AS total, round(avg(rating), 6) AS mean
FROM v_ratings_train GROUP BY item_id""")
def intake_item_stats(spark, sf):
    """The train ratings arrive as files, a few per core; a Structured
    Streaming query takes an eighth of them per micro-batch and keeps per-item
    count and sum in its state store. After all files the published table must equal the batch
    ``item_rating_stats``."""
    run = scratch_path(spark, f"intake-{uuid.uuid4().hex}")
    ratings = V.ratings_train(spark, sf).select("user_id", F.col("item_id").cast("int"), "rating")
    # one state partition per core: the state is one row per item
    parts = spark.sparkContext.defaultParallelism
    ratings.repartition(parts, "user_id").write.parquet(f"{run}/in")
    q = item_stats_stream(spark, f"{run}/in", f"{run}/out", f"{run}/state", files_per_batch=-(-parts // 8),
                          state_partitions=parts)
    q.awaitTermination()
    return read_stats(spark, f"{run}/out")


@query("intake_latest_ratings", """
SELECT item_id, count(*) AS n, round(sum(rating), 6) AS total, round(avg(rating), 6) AS mean
FROM v_ratings_all GROUP BY item_id""")
def intake_latest_ratings(spark, sf):
    """Z1, latest wins: all events arrive as files, re-rated pairs among them;
    the stream's keyed state takes a replaced rating out of its item's sums.
    The published table equals the batch statistics of the latest ratings."""
    run = scratch_path(spark, f"latest-{uuid.uuid4().hex}")
    events = load(spark, sf, "events").select(
        "user_id", F.regexp_extract("props", r"([0-9]+)", 1).try_cast("int").alias("item_id"),
        ((F.floor("value") % 5) + 1).cast("double").alias("rating"), F.col("event_id").alias("at"))
    parts = spark.sparkContext.defaultParallelism
    events.repartition(parts, "at").write.parquet(f"{run}/in")
    q = latest_ratings_stream(spark, f"{run}/in", f"{run}/out", f"{run}/state", files_per_batch=-(-parts // 4),
                              state_partitions=parts, compact_every=2)
    q.awaitTermination()
    return read_latest_stats(spark, f"{run}/out")
