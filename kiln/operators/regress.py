"""Linear regression per key from sufficient statistics.

A key's rows are only summed: means first, then the products of the centred
values, X'X and X'y. Both are aggregates that combine map-side, so a series
with a third of all rows is no larger than any other after its task's partial
sums. The normal equations are one row per key and are solved there by a
Cholesky decomposition in columns, for any number of keys. A value that
depends on those before it (a pivot of zero) gets the coefficient 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIVOT = 1e-10  # least share of a value's own variance that must be new


def _total(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def fit_by_key(rows: DataFrame, key: str, x: str, y: str, t: int) -> DataFrame:
    """(key, n, coef, intercept): least squares of ``y`` on the ``t`` values of
    the array ``x``, a row per key. Rows with a null are left out."""
    xs = [F.get(F.col(x), F.lit(i)).cast("double").alias(f"_x{i}") for i in range(t)]
    values = rows.select(key, *xs, F.col(y).cast("double").alias(f"_x{t}")).dropna(subset=[f"_x{i}" for i in range(t + 1)])
    means = values.groupBy(key).agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"_x{i}").alias(f"_m{i}") for i in range(t + 1)])
    c = values.join(means, key)
    centred = [F.col(f"_x{i}") - F.col(f"_m{i}") for i in range(t + 1)]
    sums = c.groupBy(key).agg(*[F.sum(centred[i] * centred[j]).alias(f"_s{i}_{j}") for i in range(t + 1) for j in range(min(i, t - 1) + 1)])
    m = means.join(sums, key)
    col = F.col
    for j in range(t):  # column j of L with S = L L'; its entries below the diagonal hold row t (X'y) as well
        rest = [col(f"_s{i}_{j}") - _total([col(f"_l{i}_{k}") * col(f"_l{j}_{k}") for k in range(j)]) if j else col(f"_s{i}_{j}")
                for i in range(j, t + 1)]
        m = m.withColumn("_pivot", F.when(rest[0] > PIVOT * col(f"_s{j}_{j}"), F.sqrt(F.greatest(rest[0], F.lit(0.0)))))
        m = m.withColumns({f"_l{i}_{j}": F.coalesce(F.try_divide(r, col("_pivot")), F.lit(0.0))
                           for i, r in zip(range(j, t + 1), rest)})
    for j in range(t - 1, -1, -1):  # L' b = (row t of L)
        behind = [col(f"_l{i}_{j}") * col(f"_b{i}") for i in range(j + 1, t)]
        rest = col(f"_l{t}_{j}") - _total(behind) if behind else col(f"_l{t}_{j}")
        m = m.withColumn(f"_b{j}", F.coalesce(F.try_divide(rest, F.when(col(f"_l{j}_{j}") > 0, col(f"_l{j}_{j}"))), F.lit(0.0)))
    b = [col(f"_b{i}") for i in range(t)]
    return m.select(key, "n", F.array(*b).alias("coef"),
                    (col(f"_m{t}") - _total([col(f"_m{i}") * b[i] for i in range(t)])).alias("intercept"))


def predict_by_key(rows: DataFrame, models: DataFrame, key: str, x: str, name: str = "pred") -> DataFrame:
    """``rows`` with the prediction of their key's model; null without one."""
    dot = F.aggregate(F.zip_with(x, "coef", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return (rows.join(models.select(key, "coef", "intercept"), key, "left")
            .withColumn(name, F.col("intercept") + dot).drop("coef", "intercept"))
