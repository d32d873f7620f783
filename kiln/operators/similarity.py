"""Vector and document similarity, nearest neighbours (T7, M5, C7). Joins above
a similarity threshold are in ``simjoin``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from kiln.functions.columns import dot, norm2
from kiln.operators import knn
from kiln.session import ship_package


def cosine_sparse(weights: DataFrame, doc: str = "doc", term: str = "term", weight: str = "weight",
                  digits: int = 6) -> DataFrame:
    """Cosine of every document pair (doc1 < doc2) sharing a term, from a
    long (doc, term, weight) table: normalise, join on term, sum products.
    Callers bound the document set (the reference compares the 100 most
    recent plots); the output is the pairwise matrix itself."""
    norms = weights.groupBy(doc).agg(F.sqrt(F.sum(F.col(weight) * F.col(weight))).alias("_norm"))
    w = weights.join(norms, doc).withColumn("_w", F.col(weight) / F.col("_norm"))
    a = w.select(F.col(doc).alias("doc1"), term, F.col("_w").alias("w1"))
    b = w.select(F.col(doc).alias("doc2"), term, F.col("_w").alias("w2"))
    return (a.join(b, term).filter(F.col("doc1") < F.col("doc2"))
            .groupBy("doc1", "doc2").agg(F.round(F.sum(F.col("w1") * F.col("w2")), digits).alias("cosine")))


def cosine_to(df: DataFrame, vec: str, other: Column, name: str = "cosine", digits: int = 6) -> DataFrame:
    """Dense cosine of each row's vector with another array column."""
    c = F.try_divide(dot(vec, other), norm2(vec) * norm2(other))
    return df.withColumn(name, F.round(c, digits))


def centroids(df: DataFrame, vec: str, key: str) -> DataFrame:
    """Mean vector per key, one aggregate over the exploded components."""
    e = df.select(key, F.posexplode(vec).alias("_d", "_v"))
    m = e.groupBy(key, "_d").agg(F.avg("_v").alias("_m"))
    return m.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_d", "_m"))).alias("_s")) \
        .select(key, F.transform("_s", lambda s: s["_m"]).alias("centroid"))


def assign_to_centres(df: DataFrame, vec: str, centres: Sequence[Sequence[float]], digits: int = 6) -> DataFrame:
    """Nearest of k given centres per row (ties to the lower index) and
    its squared distance. The centres are one array literal; no join."""
    table = F.array(*[F.struct(F.lit(i).alias("label"), F.array(*[F.lit(float(x)) for x in c]).alias("centre"))
                      for i, c in enumerate(centres)])
    return nearest_centre(df, vec, table, digits)


def nearest_centre(df: DataFrame, vec: str, centres: Column, digits: int = 6) -> DataFrame:
    """Label of the nearest entry of ``centres`` (an array of (label,
    centre), a literal or a scalar subquery) per row, ties to the lower label."""
    def entry(c: Column) -> Column:
        d = F.aggregate(F.zip_with(F.col(vec), c["centre"], lambda u, v: (u - v) * (u - v)), F.lit(0.0),
                        lambda acc, x: acc + x)
        return F.struct(d.alias("d"), c["label"].alias("label"))
    best = F.array_min(F.transform("_centres", entry))
    return (df.withColumn("_centres", centres).withColumn("_best", best).withColumn("cluster", F.col("_best.label"))
            .withColumn("sq_dist", F.round("_best.d", digits)).drop("_best", "_centres"))


def sq_euclid(a, b) -> Column:
    """Squared Euclidean distance of two arrays."""
    return F.aggregate(F.zip_with(a, b, lambda u, v: (u - v).cast("double") * (u - v)), F.lit(0.0), lambda acc, x: acc + x)


def knn_neighbours(test: DataFrame, train: DataFrame, id_col: str, vec: str, label: str, k: int,
                   pivots: int = 1, block_rows: int = 16384) -> DataFrame:
    """M5 (neighbour search): the k nearest train rows of every test row by
    squared Euclidean distance, ties by train id, exact.

    Both sides are dealt over blocks of about ``block_rows`` rows by a hash of
    the id, train rows over ``pivots`` blocks at least; each (test block, train block) meets once, as two matrices in one
    task (``kiln.operators.knn``). Pairs never become rows: a cell hands on at
    most k rows per test row, and the k best of these are kept. Numbers of
    blocks come from counts inside the plan. Rows without a vector, or with a
    null in it, neither have nor are neighbours."""
    def sound(df: DataFrame) -> DataFrame:
        return df.filter(F.col(vec).isNotNull() & ~F.exists(vec, lambda c: c.isNull()))

    def blocks(df: DataFrame) -> Column:
        return sound(df).agg(F.greatest(F.ceil(F.count(F.lit(1)) / block_rows), F.lit(1)).cast("int").alias("n")).select("n").scalar()

    def dealt(df: DataFrame, columns: list[Column], own: str, other: str, n_own: Column, n_other: Column) -> DataFrame:
        return sound(df).select(*columns, F.pmod(F.xxhash64(id_col), n_own).cast("int").alias(own),
                                F.explode(F.sequence(F.lit(0), n_other - 1)).alias(other))
    n_test, n_train = blocks(test), F.greatest(blocks(train), F.lit(pivots))
    values = F.col(vec).cast("array<double>").alias("v")
    q = dealt(test, [F.col(id_col).alias("id"), values], "i", "j", n_test, n_train)
    t = dealt(train, [F.col(id_col).alias("neighbour"), F.col(label).alias("neighbour_label"), values],
              "j", "i", n_train, n_test)
    schema = StructType([StructField("id", test.schema[id_col].dataType), StructField("neighbour", train.schema[id_col].dataType),
                         StructField("neighbour_label", train.schema[label].dataType), StructField("sq_dist", DoubleType())])
    ship_package(test.sparkSession)
    met = q.groupBy("i", "j").cogroup(t.groupBy("i", "j")).applyInArrow(knn.nearest_in_cell(k), schema)
    best = Window.partitionBy("id").orderBy("sq_dist", "neighbour")
    return (met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select(F.col("id").alias(id_col), "neighbour", "neighbour_label", "sq_dist", "rank"))


def knn_vote(neigh: DataFrame, id_col: str, weights: str = "uniform") -> DataFrame:
    """M5 (vote): majority label among the neighbours, ties to the smallest
    label; 'distance' weights 1/d, where an exact match (d = 0) decides alone."""
    if weights == "uniform":
        w = F.lit(1.0)
    else:
        w = F.when(F.col("sq_dist") == 0, F.lit(1e300)).otherwise(1.0 / F.sqrt("sq_dist"))
    # rounded, so that equal sums of weights tie in any order of summation
    votes = neigh.groupBy(id_col, "neighbour_label").agg(F.round(F.sum(w), 9).alias("_v"))
    best = votes.groupBy(id_col).agg(F.max_by("neighbour_label",
                                               F.struct(F.col("_v"), -F.col("neighbour_label"))).alias("prediction"))
    return best
