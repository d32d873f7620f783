"""Count, share, cross-table and summary reports.

Every function is DataFrame -> DataFrame and builds one declarative plan.
Aggregations are hash aggregates with map-side partial aggregation, so a hot
key (a third of all rows in one group) is combined on the map side and only
one partial row per task crosses the shuffle. Totals used as denominators are
scalar subqueries (computed once, shipped as a literal), never a window over
the whole table and never a cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions.columns import col, pct, safe_div


def _list(x) -> list:
    return [x] if isinstance(x, (str, Column)) else list(x)


def counts(df: DataFrame, by, where: Column | None = None, name: str = "n") -> DataFrame:
    """Rows per group, largest first, ties by the keys."""
    by = _list(by)
    src = df.filter(where) if where is not None else df
    out = src.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(F.desc(name), *[col(b) for b in by])


def total_of(df: DataFrame, column: str) -> Column:
    """Scalar subquery: the sum of ``column`` over ``df`` as a literal-like column."""
    return df.agg(F.sum(column)).scalar()


def shares(df: DataFrame, by, name: str = "n", digits: int = 6) -> DataFrame:
    """A2: count and percentage of all rows per group."""
    c = df.groupBy(*_list(by)).agg(F.count(F.lit(1)).alias(name))
    return c.withColumn("pct", F.round(safe_div(F.col(name) * 100.0, total_of(c, name)), digits))


def shares_within(df: DataFrame, by, cls: str, name: str = "n", digits: int = 6) -> DataFrame:
    """A3: count and percentage per group inside each class.

    Class totals are an aggregate of the aggregate (one row per class) joined
    back on the class; AQE broadcasts it when its run-time size is small.
    """
    by = _list(by)
    c = df.groupBy(cls, *by).agg(F.count(F.lit(1)).alias(name))
    tot = c.groupBy(cls).agg(F.sum(name).alias("_class_total"))
    return (c.join(tot, cls)
            .withColumn("pct", F.round(safe_div(F.col(name) * 100.0, "_class_total"), digits))
            .drop("_class_total"))


def conditional_share(df: DataFrame, by, condition: Column, matched: str = "matched",
                      digits: int = 4) -> DataFrame:
    """Per group the row count, the count meeting ``condition`` and its
    percentage, in one pass. Groups with no matching row keep a 0 (the zero
    fill the reference needed a left join for)."""
    return (df.groupBy(*_list(by))
            .agg(F.count(F.lit(1)).alias("total"), F.count_if(condition).alias(matched))
            .withColumn(f"{matched}_pct", pct(matched, "total", digits)))


def rating_stats(df: DataFrame, by, value: str = "rating", digits: int = 6) -> DataFrame:
    """Count, sum and mean per key."""
    return (df.groupBy(*_list(by))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), digits).alias("total"),
                 F.round(F.avg(value), digits).alias("mean")))


def loo_mean(ratings: DataFrame, user: str = "user_id", value: str = "rating") -> DataFrame:
    """For every rating, the user's mean without that rating;
    0.0 when the user has a single rating. One aggregate, joined back on user."""
    s = ratings.groupBy(user).agg(F.sum(value).alias("_s"), F.count(F.lit(1)).alias("_n"))
    j = ratings.join(s, user)
    loo = F.when(F.col("_n") > 1, (F.col("_s") - F.col(value)) / (F.col("_n") - 1)).otherwise(F.lit(0.0))
    return j.withColumn("loo_mean", F.round(loo, 6)).drop("_s", "_n")


def sum_by(df: DataFrame, by, value: str, name: str | None = None) -> DataFrame:
    """Sum of a value per group."""
    return df.groupBy(*_list(by)).agg(F.sum(value).alias(name or f"sum_{value}"))


def crosstab(df: DataFrame, feature: str, label: str, values: Sequence) -> DataFrame:
    """Count table of feature value x label, the label spread to columns.

    The label values are given, so ``pivot`` needs no extra job to find them;
    missing combinations are 0."""
    p = df.groupBy(feature).pivot(label, list(values)).agg(F.count(F.lit(1)))
    out = p.select(F.col(feature).alias("value"),
                   *[F.coalesce(F.col(str(v)), F.lit(0)).cast("long").alias(f"{label}_{v}") for v in values])
    return out


def unpivot_str(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Many columns to (feature, value) rows, values as text, in one pass."""
    cast = df.select(*keep, *[F.col(f).cast("string").alias(f) for f in features])
    return cast.unpivot(list(keep), list(features), "feature", "value")


def rate_by_value(df: DataFrame, features: Sequence[str], label: str, digits: int = 6) -> DataFrame:
    """Per feature and value the row count and the mean label, all features
    in one scan and one shuffle (instead of one job per feature)."""
    long = unpivot_str(df, features, keep=[label])
    return (long.groupBy("feature", "value")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(label), digits).alias("rate")))


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of distinct values per column as (column, n_distinct):
    unpivot, de-duplicate (feature, value) with partial aggregation, count per
    feature. ``distinct_sketches`` is the form with bounded memory."""
    long = unpivot_str(df, cols).filter(F.col("value").isNotNull())
    return (long.select("feature", "value").distinct()
            .groupBy(F.col("feature").alias("column")).agg(F.count(F.lit(1)).alias("n_distinct")))


SKETCH_LG = 14  # log2 of a sketch's registers: standard error 1.04 / 2**7, 0.8 %


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str, lg: int = SKETCH_LG) -> DataFrame:
    """One HyperLogLog sketch of the distinct values per group, as a
    binary column ``sketch`` that can be stored and merged later. Memory and
    shuffle per group are bounded by the sketch, whatever the number of values."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(value), F.lit(lg)).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of finer groups (days, say) put together per ``keys``: the
    sketch of the union, without the values."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def sketch_counts(sketches: DataFrame, name: str = "n_distinct") -> DataFrame:
    """Estimated number of distinct values of each sketch."""
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing values per column and in total, as (column, n_null)."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    per = row.unpivot([], list(cols), "column", "n_null")
    total = row.select(F.lit("_total").alias("column"), sum(F.col(c) for c in cols).alias("n_null"))
    return per.unionByName(total)


def class_means(df: DataFrame, cols: Sequence[str], cls: str, digits: int = 6) -> DataFrame:
    """Mean of each numeric column per class."""
    return df.groupBy(cls).agg(*[F.round(F.avg(c), digits).alias(f"mean_{c}") for c in cols])


def audience(df: DataFrame, by: str, user: str) -> DataFrame:
    """Distinct users per group, largest first. The distinct is planned as
    a two-level aggregate (group, user) then count, so no group holds a set."""
    return (df.select(by, user).distinct().groupBy(by).agg(F.count(F.lit(1)).alias("users"))
            .orderBy(F.desc("users"), by))


def audience_share(df: DataFrame, by: str, user: str, positive: Column, min_users: int = 1,
                   digits: int = 6) -> DataFrame:
    """Distinct users per group, how many of them are positive (any
    positive row), their share and a two-proportion z against all other
    groups pooled. Groups below ``min_users`` are dropped."""
    per_user = df.groupBy(by, user).agg(F.max(positive.cast("int")).alias("_pos"))
    g = per_user.groupBy(by).agg(F.count(F.lit(1)).alias("users"), F.sum("_pos").alias("positive"))
    tot = g.agg(F.sum("users").alias("u"), F.sum("positive").alias("p"))
    all_u, all_p = tot.select("u").scalar(), tot.select("p").scalar()
    n1, x1 = F.col("users"), F.col("positive")
    n2, x2 = all_u - n1, all_p - x1
    p1, p2 = safe_div(x1, n1), safe_div(x2, n2)
    pool = safe_div(x1 + x2, n1 + n2)
    se = F.sqrt(pool * (1 - pool) * (F.try_divide(F.lit(1.0), n1) + F.try_divide(F.lit(1.0), n2)))
    return (g.filter(F.col("users") >= min_users)
            .withColumn("share", F.round(p1, digits))
            .withColumn("z", F.round(F.try_divide(p1 - p2, F.when(se > 0, se)), digits)))


def histogram(df: DataFrame, column: str, bins: int, cls: str | None = None, digits: int = 6) -> DataFrame:
    """K equal-width bins between the column's min and max; count per
    (class, bin) and percentage within the class.

    min/max come from one scalar-subquery aggregate; binning is arithmetic
    ``least(k-1, floor((x-min)/(max-min)*k))`` so no sort is needed."""
    x = F.col(column).cast("double")
    mm = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    lo, hi = mm.select("lo").scalar(), mm.select("hi").scalar()
    width = F.try_divide(hi - lo, F.lit(float(bins)))
    b = F.least(F.lit(bins - 1), F.floor(F.coalesce(F.try_divide((x - lo) * bins, hi - lo), F.lit(0.0)))).cast("int")
    keys = [cls] if cls else []
    c = (df.filter(x.isNotNull()).groupBy(*keys, b.alias("bin"))
         .agg(F.count(F.lit(1)).alias("n")))
    if cls:
        tot = c.groupBy(cls).agg(F.sum("n").alias("_t"))
        c = c.join(tot, cls)
    else:
        c = c.withColumn("_t", total_of(c, "n"))
    return (c.withColumn("lo", F.round(lo + F.col("bin") * width, digits))
            .withColumn("hi", F.round(lo + (F.col("bin") + 1) * width, digits))
            .withColumn("pct", F.round(safe_div(F.col("n") * 100.0, "_t"), digits))
            .drop("_t"))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """K2/K4/K5: first n rows of a total order (TakeOrderedAndProject:
    each task keeps its own n best, the driver merges tasks x n rows)."""
    return df.orderBy(*order).limit(n)


def top_and_bottom(df: DataFrame, value: str, tie, n: int) -> DataFrame:
    """K3: the n largest and n smallest rows, tagged, in one union."""
    tie = _list(tie)
    top = df.orderBy(F.desc(value), *tie).limit(n).withColumn("end", F.lit("top"))
    bottom = df.orderBy(F.asc(value), *tie).limit(n).withColumn("end", F.lit("bottom"))
    return top.unionByName(bottom)


def top_per_key(df: DataFrame, key, order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The n first rows per key. ``row_number() <= n`` is planned as a
    WindowGroupLimit, which drops rows per key before the shuffle."""
    w = Window.partitionBy(*_list(key)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def detail_of_top(df: DataFrame, top_by: str, k: int, by: Sequence[str]) -> DataFrame:
    """Counts by ``by`` restricted to the k largest groups of ``top_by``.

    The top-k is a tiny table (k rows) used as a left-semi filter; the
    planner broadcasts it."""
    top = counts(df, top_by).limit(k).select(top_by)
    return counts(df.join(F.broadcast(top), top_by, "left_semi"), [top_by, *by])


def keys_with_min_rows(df: DataFrame, key: str, more_than: int) -> DataFrame:
    """Rows of keys that have more than n rows, as a left-semi join."""
    big = df.groupBy(key).count().filter(F.col("count") > more_than).select(key)
    return df.join(big, key, "left_semi")
