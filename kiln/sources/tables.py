"""Loading of the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table as a lazy parquet scan; column pruning and filters reach the
    scan through Catalyst, so callers select only what they need."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """A scan whose files give fewer splits than there are cores (one small
    file, say), dealt over the cores by its row id before CPU-heavy work such
    as tokenising whole texts. A table of many splits is left as it is, so a
    large corpus is never shuffled for a scan."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
