"""Shared parts of the training-data operators: written stages in the shared
folder, keys that may hold a large share of all rows, and row numbers."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import checkpoint_dir, scratch_path, ship_package, shuffles_dropped

SEPARATORS = r"\x20\x09-\x0D"  # inside a character class
#: At most so many keys are dealt over sub-keys, if they hold over so many rows.
HOT_KEYS = 1000
HOT_ROWS = 1000


def prepare(spark: SparkSession) -> None:
    """Shared folder and package for the executors; called by every operator
    that writes stages or runs Python in tasks."""
    checkpoint_dir(spark)
    ship_package(spark)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder of this run under ``spark.checkpoint.dir``."""
    prepare(spark)
    return scratch_path(spark, f"kiln-{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a written table: its rows are fixed once, lineage ends here,
    and a lost executor costs only a new read. The shuffle files of the job
    serve nobody after that and are dropped with its end."""
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_by_one(files: DataFrame, most: int = 10_000) -> DataFrame:
    """A list of files dealt over as many tasks as it has rows (``most`` at
    most), although the list itself is small."""
    return files.repartition(max(min(files.count(), most), 1), *files.columns)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete stages that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has (Spark compares
    names without regard to case)."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        n = f"_{n}"
        while n.lower() in have:
            n = f"_{n}"
        have.add(n.lower())
        out.append(n)
    return out


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a whole text, unchanged; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SEPARATORS}]+", -1), "")


def word_count(text: Column) -> Column:
    return F.size(word_array(text)).cast("long")


def hot_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The HOT_KEYS keys with most rows, of those with over HOT_ROWS, as
    columns 0, 1, ... and ``copies`` (sub-keys to deal a key over): a list of
    bounded length, whatever the input, beyond which no key holds more than
    1 / HOT_KEYS of the rows. None if no key is hot."""
    copies, = fresh(rows, "copies")
    hot = (rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(copies)).filter(F.col(copies) > HOT_ROWS)
           .select(*[F.col(k).alias(str(i)) for i, k in enumerate(keys)], F.ceil(F.col(copies) / HOT_ROWS).alias("copies"))
           .orderBy(F.desc("copies")).limit(HOT_KEYS))
    found = hot.collect()
    return rows.sparkSession.createDataFrame(found, hot.schema) if found else None


def join_hot(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner",
             hot: list[DataFrame | None] | None = None) -> DataFrame:
    """Join ``rows`` with ``table`` (at most one row per key) on ``keys``,
    where a few keys may hold much of ``rows``.

    A hot key (``hot_keys``, looked up here unless ``hot`` holds the answer
    for these rows and keys) is dealt over a sub-key per HOT_ROWS rows by a
    hash of the row's other columns; ``table`` repeats its row of that key for
    each sub-key. All other keys join as usual. Keys are compared null-safe.
    ``rows`` is read twice: pass a written table.
    """
    keys = list(keys)
    others = [c for c in table.columns if c not in keys]
    taken = rows.select(*rows.columns, *[F.lit(1).alias(c) for c in others])
    copies, salt, other_salt, *parts = fresh(taken, "copies", "salt", "salt2", *[f"key{i}" for i in range(len(keys))])
    listed = hot_keys(rows, keys) if hot is None else hot[0]

    def same(a: DataFrame, b: DataFrame):
        return reduce(and_, [a[k].eqNullSafe(b[p]) for k, p in zip(keys, parts)])

    if listed is None:
        right = table.select(*[F.col(k).alias(p) for k, p in zip(keys, parts)], *others)
        return rows.join(right, same(rows, right), how).drop(*parts)
    listed = listed.select(*[F.col(str(i)).alias(p) for i, p in enumerate(parts)], F.col("copies").alias(copies))

    def with_copies(df: DataFrame) -> DataFrame:
        return (df.join(F.broadcast(listed), same(df, listed), "left").drop(*parts)
                .withColumn(copies, F.coalesce(copies, F.lit(1))))

    row_hash = F.xxhash64(*[F.col(c) for c in rows.columns if c not in keys] or [F.lit(0)])
    left = with_copies(rows).withColumn(salt, F.pmod(row_hash, F.col(copies))).drop(copies)
    right = (with_copies(table).withColumn(salt, F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1)))
             .select(*[F.col(k).alias(p) for k, p in zip(keys, parts)], F.col(salt).alias(other_salt), *others))
    return left.join(right, same(left, right) & (left[salt] == right[other_salt]), how).drop(salt, other_salt, *parts)
