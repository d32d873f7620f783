"""Canonical views: fixed projections of the driver's tables that stand in for
the inputs of the reference projects (ratings, incidents, ad impressions,
customers, comments, movie plots, prices, points, scored labels).

Each view is a lazy DataFrame over the parquet scan, so Catalyst prunes the
columns a query does not use and pushes its filters into the scan. The same
definitions exist as SQL text in ``kiln.plans.oracle_views`` for the DuckDB
oracle; both must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.sources.tables import load, spread

# Fixed values of the fixture design (FIXTURES.md section 3).
TEST_MOD = 5           # (user_id * 31 + item_id) % 5 = 0  -> test pair
COLD_USER_MOD = 13     # users with user_id % 13 = 0 never appear in train
COLD_ITEM_MOD = 17     # items with item_id % 17 = 0 never appear in train


def _item_of(props: str = "props"):
    return F.regexp_extract(F.col(props), r"([0-9]+)", 1).try_cast("int")


def ratings_all(spark: SparkSession, sf: str) -> DataFrame:
    """(user_id, item_id, rating): the latest event per user-item pair.

    ``max_by`` keeps it a hash aggregate with map-side partial aggregation
    (no sort, no window), so a hot user or item is combined before the shuffle.
    """
    ev = load(spark, sf, "events")
    rating = ((F.floor("value") % 5) + 1).cast("double")
    return (ev.select("user_id", _item_of().alias("item_id"), rating.alias("rating"), "event_id")
            .groupBy("user_id", "item_id")
            .agg(F.max_by("rating", "event_id").alias("rating")))


def _is_test():
    return (F.col("user_id") * 31 + F.col("item_id")) % TEST_MOD == 0


def ratings_test(spark: SparkSession, sf: str) -> DataFrame:
    return ratings_all(spark, sf).filter(_is_test())


def ratings_train(spark: SparkSession, sf: str) -> DataFrame:
    return ratings_all(spark, sf).filter(
        ~_is_test() & (F.col("user_id") % COLD_USER_MOD != 0) & (F.col("item_id") % COLD_ITEM_MOD != 0))


def incidents(spark: SparkSession, sf: str) -> DataFrame:
    ev = load(spark, sf, "events")
    resolution = (F.when(F.col("event_type") == "signup", F.lit(" ARREST"))
                  .when(F.col("event_id") % 3 == 0, F.lit("NONE "))
                  .otherwise(F.lit(" ARREST")))
    return ev.select(
        F.col("event_id").alias("incident_id"),
        F.col("event_type").alias("category"),
        F.concat(F.lit("D"), (F.col("user_id") % 10).cast("string")).alias("district"),
        "ts",
        F.date_format("ts", "MM/dd/yyyy").alias("date_text"),
        F.date_format("ts", "HH:mm").alias("time_text"),
        F.date_format("ts", "EEEE").alias("day_of_week"),
        (F.lit(-122.5) + (F.col("user_id") % 100) * F.lit(0.002)).alias("x"),
        (F.lit(37.7) + (F.col("event_id") % 97) * F.lit(0.002)).alias("y"),
        resolution.alias("resolution"),
    )


def impressions(spark: SparkSession, sf: str) -> DataFrame:
    ev = load(spark, sf, "events")
    k = _item_of()
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("event_type").isin("click", "purchase").cast("int").alias("click"),
        F.date_format("ts", "yyMMddHH").alias("hour_code"),
        (F.col("user_id") % 7).alias("c1"),
        (F.col("event_id") % 5).alias("banner_pos"),
        k.alias("site_id"),
        F.concat(F.lit("s"), (k % 10).cast("string")).alias("site_category"),
        F.col("user_id").alias("device_id"),
        "value",
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """One row per customer: order count, total, mean and first date from a
    pre-aggregated orders table (partial aggregation before the join)."""
    orders = (load(spark, sf, "orders")
              .groupBy("o_custkey")
              .agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("s"),
                   F.min("o_orderdate").alias("d")))
    c = load(spark, sf, "customer")
    j = c.join(orders, c.c_custkey == orders.o_custkey, "left")
    total = F.round(F.coalesce(F.col("s"), F.lit(0.0)), 2)
    n = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    return j.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation"),
        n.alias("n_orders"),
        total.alias("order_total"),
        F.round(F.try_divide(total, n), 4).alias("avg_order"),
        F.col("d").cast("date").alias("first_order"),
        ((F.col("c_custkey") * 7) % 73).alias("tenure"),
        F.when(F.col("c_custkey") % 50 == 0, F.lit(" "))
         .otherwise(total.cast("decimal(18,2)").cast("string")).alias("total_charge"),
        F.when(F.col("c_acctbal") < 0, F.lit(" True.")).otherwise(F.lit(" False.")).alias("churn_text"),
        (F.col("c_acctbal") < 0).cast("int").alias("churned"),
    )


def comments(spark: SparkSession, sf: str) -> DataFrame:
    d = spread(load(spark, sf, "documents"), "doc_id")
    return d.select(
        F.col("doc_id").alias("comment_id"),
        F.col("source").alias("creator_name"),
        (F.col("doc_id") % 97).alias("userid"),
        F.lower("text").alias("comment"),
    )


def movies(spark: SparkSession, sf: str) -> DataFrame:
    d = spread(load(spark, sf, "documents"), "doc_id")
    return d.select(
        F.col("doc_id").alias("movie_id"),
        (F.lit(1980) + F.col("doc_id") % 40).alias("year"),
        F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("title"),
        F.col("source").alias("origin"),
        F.when(F.col("doc_id") % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat_ws("/", "lang", "source")).alias("genre"),
        F.col("lang"),
        F.col("text").alias("plot"),
    )


def prices(spark: SparkSession, sf: str) -> DataFrame:
    o = load(spark, sf, "orders")
    return (o.groupBy(F.col("o_orderpriority").alias("name"), F.col("o_orderdate").cast("date").alias("date"))
            .agg(F.round(F.avg("o_totalprice"), 4).alias("price")))


def points(spark: SparkSession, sf: str) -> DataFrame:
    e = load(spark, sf, "embeddings")
    return e.select(
        F.col("vec_id").alias("point_id"),
        F.col("embedding").getItem(0).cast("double").alias("x"),
        F.col("embedding").getItem(1).cast("double").alias("y"),
        F.col("embedding").cast("array<double>").alias("features"),
        F.col("label").cast("long").alias("label"),
    )


def scored(spark: SparkSession, sf: str) -> DataFrame:
    lab = load(spark, sf, "labels")
    doc = load(spark, sf, "documents").select("doc_id", "n_chars")
    score = (F.col("n_chars") % 1000) / F.lit(1000.0)
    return (lab.join(doc, "doc_id")
            .select("doc_id", F.col("quality").cast("long").alias("label"),
                    score.alias("score"), (score > 0.5).cast("long").alias("prediction")))
