"""Feature preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.columns import hash_code
from kiln.operators.report import distinct_counts


def category_values(df: DataFrame, column: str) -> list:
    """Distinct values of a categorical column, sorted. They become column
    names, so there are as many as the wide table has columns."""
    return sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().toLocalIterator())


def one_hot(df: DataFrame, column: str, values: Sequence | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Wide 0/1 columns ``<column>_<value>`` (dropLast=False); a null is 0
    in all of them."""
    values = list(values) if values is not None else category_values(df, column)
    return df.select(*keep, *[F.col(column).eqNullSafe(F.lit(v)).cast("int").alias(f"{column}_{v}") for v in values])


def standardise(train: DataFrame, df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
                digits: int = 6) -> DataFrame:
    """(x - mean) / population std, both fitted on ``train`` in one
    aggregate and applied to ``df`` as scalar subqueries. Zero std -> NULL.
    (Spark's StandardScaler uses the sample std, hence this column form.)"""
    stats = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])
    out = []
    for c in cols:
        m, s = stats.select(f"m_{c}").scalar(), stats.select(f"s_{c}").scalar()
        out.append(F.round(F.try_divide(F.col(c) - m, F.when(s != 0, s)), digits).alias(f"z_{c}"))
    return df.select(*keep, *out)


def split_columns(df: DataFrame, cols: Sequence[str], limit: int = 7) -> DataFrame:
    """Columns with fewer than ``limit`` distinct values are categorical."""
    d = distinct_counts(df, cols)
    return d.withColumn("kind", F.when(F.col("n_distinct") < limit, "categorical").otherwise("numeric"))


def time_features(df: DataFrame, ts: str, keep: Sequence[str] = ()) -> DataFrame:
    """Date, hour, month, weekday name and weekend flag."""
    t = F.col(ts)
    wd = F.date_format(t, "EEEE")
    return df.select(*keep, t.cast("date").alias("date"), F.hour(t).cast("long").alias("hour"),
                     F.month(t).cast("long").alias("month"), wd.alias("weekday"),
                     wd.isin("Saturday", "Sunday").alias("is_weekend"))


def hash_features(df: DataFrame, cols: Sequence[str], buckets: int, keep: Sequence[str] = ()) -> DataFrame:
    """Each categorical value to a stable code in [0, buckets)."""
    return df.select(*keep, *[hash_code(c, buckets).alias(f"{c}_code") for c in cols])


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Feature vector; rows with a NULL or NaN input are skipped."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="skip").transform(df)


def pca(df: DataFrame, vec: str, k: int = 2, out: str = "pca"):
    """E5: principal components of centred vectors -> (model, projected rows)."""
    from pyspark.ml.feature import StandardScaler
    centred = StandardScaler(inputCol=vec, outputCol="_centred", withMean=True, withStd=False).fit(df).transform(df)
    model = PCA(k=k, inputCol="_centred", outputCol=out).fit(centred)
    return model, model.transform(centred).drop("_centred")


def pca_sparse(df: DataFrame, vec: str, k: int = 2, out: str = "pca"):
    """E5 for sparse vectors, such as TF-IDF: (model, projected rows). The
    covariance is summed from the vectors' own entries and centred afterwards
    (Spark's ``PCA`` adds up outer products in a tree and subtracts the means'),
    so no row becomes dense; the mean is subtracted from the projection. The
    dimension bounds the work: d x d / 2 numbers per task."""
    model = PCA(k=k, inputCol=vec, outputCol=out).fit(df)
    mean = df.select(Summarizer.mean(F.col(vec)).alias("m")).first()["m"]
    shift = model.pc.toArray().T @ mean.toArray()
    at = F.array(*[F.lit(float(x)) for x in shift])
    return model, model.transform(df).withColumn(out, F.zip_with(vector_to_array(out), at, lambda a, m: a - m))
