"""Sampling and splitting.

Spark's ``sample`` / ``randomSplit`` / ``sampleBy`` draw per row from a
partition-seeded generator, so the result changes with partitioning. The
stable forms here decide per row from an MD5 hash of key and seed: the same
row is kept or put in the same split on any cluster, and retried tasks give
the same answer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 16


def key_hash(key: str, seed: int):
    """60 bits of the MD5 of key and seed as a long; any engine with MD5
    gives the same number."""
    text = F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _unit(key: str, seed: int):
    """A per-row number in [0, 1) from the key and the seed."""
    return key_hash(key, seed) / F.lit(float(1 << 60))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all when fewer): those with the least key
    hashes, ties by key.

    Rows are counted per bucket of the hash (``BUCKETS`` rows of counts); all
    buckets before the n-th row stay whole, and only the one that holds it is
    put in order. One way for every n, and no task holds n rows."""
    h = key_hash(key, seed)
    bucket = F.shiftright(h, 44)
    counts = df.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # at most BUCKETS rows
    cut = (counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
           .filter((F.col("_before") < n) & (F.col("_before") + F.col("_n") > n)))
    whole = (counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
             .filter(F.col("_before") + F.col("_n") <= n).agg(F.max("_b").alias("_b")))
    edge, last = cut.select("_b").scalar(), whole.select("_b").scalar()
    rest = n - cut.select("_before").scalar()
    in_order = Window.partitionBy("_b").orderBy("_h", key)
    part = (df.withColumn("_h", h).withColumn("_b", bucket).filter(F.col("_b") == edge)
            .withColumn("_rank", F.row_number().over(in_order)).filter(F.col("_rank") <= rest))
    return df.filter(bucket <= last).unionByName(part.drop("_h", "_b", "_rank"))


def sample_fraction(df: DataFrame, fraction: float, key: str | None = None, seed: int = 42) -> DataFrame:
    """About ``fraction`` of the rows; stable by key hash when a key is given."""
    if key is None:
        return df.sample(False, fraction, seed)
    return df.filter(_unit(key, seed) < F.lit(float(fraction)))


def class_sample(df: DataFrame, label: str, fractions: Mapping, key: str | None = None,
                 seed: int = 42) -> DataFrame:
    """K9: keep each class with its own fraction (e.g. all positives and 1.5 %
    of negatives)."""
    if key is None:
        return df.sampleBy(label, dict(fractions), seed)
    keep = None
    for v, f in fractions.items():
        c = (F.col(label) == F.lit(v)) & (_unit(key, seed) < F.lit(float(f)))
        keep = c if keep is None else keep | c
    return df.filter(keep)


def hash_split(df: DataFrame, key: str, weights: Sequence[float], seed: int = 42,
               name: str = "split") -> DataFrame:
    """Split index 0..len(weights)-1 per row by key hash (80/20, 6/2/2...)."""
    total = float(sum(weights))
    u = _unit(key, seed)
    expr, acc = None, 0.0
    for i, w in enumerate(weights[:-1]):
        acc += w / total
        expr = F.when(u < F.lit(acc), F.lit(i)) if expr is None else expr.when(u < F.lit(acc), F.lit(i))
    expr = F.lit(0) if expr is None else expr.otherwise(F.lit(len(weights) - 1))
    return df.withColumn(name, expr)
