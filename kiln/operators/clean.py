"""Projection, filtering and cleaning (F1-F20), set operations (K6, K7) and
membership joins (F19, J5, K8)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions.columns import blank_to_null, safe_div, sq_dist


def select_rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """keep, reorder and rename columns in one projection."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """rows with no NULL in any of ``cols``."""
    return df.dropna(how="any", subset=list(cols))


def drop_repeats(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """one row per distinct value of ``cols`` (all columns when None).
    Planned as a hash aggregate with partial de-duplication per task."""
    return df.dropDuplicates(list(cols)) if cols else df.dropDuplicates()


def select_where(df: DataFrame, *conditions: Column) -> DataFrame:
    """conjunction of conditions as one filter, pushed to the scan."""
    cond = conditions[0]
    for c in conditions[1:]:
        cond = cond & c
    return df.filter(cond)


def within_radius(df: DataFrame, x: str, y: str, cx: float, cy: float, r2: float) -> DataFrame:
    """rows whose squared distance to (cx, cy) is below r2 -- column
    arithmetic instead of the reference's Python UDF."""
    d = sq_dist(x, y, cx, cy)
    return df.withColumn("sq_dist", d).filter(F.col("sq_dist") < F.lit(float(r2)))


def rule_label(df: DataFrame, text: str, positive: str, negative: str, name: str = "label") -> DataFrame:
    """1 when the positive pattern matches, else 0 when the negative
    pattern does not match, else NULL."""
    t = F.col(text)
    lab = F.when(t.rlike(positive), F.lit(1)).when(~t.rlike(negative), F.lit(0))
    return df.withColumn(name, lab.cast("int"))


def rule_conflicts(df: DataFrame, text: str, positive: str, negative: str) -> DataFrame:
    """F8: rows matched by both rules, one pass."""
    t = F.col(text)
    return df.agg(F.count_if(t.rlike(positive) & t.rlike(negative)).alias("n"))


def clean_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """trim blanks on both sides."""
    return df.select(*[F.trim(F.col(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def recode(df: DataFrame, column: str, mapping: Mapping, name: str | None = None,
           default=None) -> DataFrame:
    """map trimmed values through a fixed dictionary; others -> default."""
    t = F.trim(F.col(column).cast("string"))
    expr = None
    for k, v in mapping.items():
        expr = (F.when(t == str(k), F.lit(v)) if expr is None else expr.when(t == str(k), F.lit(v)))
    expr = expr.otherwise(F.lit(default))
    return df.withColumn(name or column, expr)


def replace_chars(df: DataFrame, column: str, src: str, dst: str, name: str | None = None) -> DataFrame:
    """character replacement inside a list-like text field."""
    return df.withColumn(name or column, F.translate(F.col(column), src, dst))


def blank_to_number(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """blank text -> NULL -> number; adds ``name`` (NULL when blank or
    malformed)."""
    return df.withColumn(name or f"{column}_num", blank_to_null(column).try_cast("double"))


def dropped_share(df: DataFrame, column: str) -> DataFrame:
    """F13 report: rows, rows lost to a NULL number, and their percentage."""
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(column).isNull()).alias("n_dropped")) \
        .withColumn("dropped_pct", F.round(safe_div(F.col("n_dropped") * 100.0, "n"), 6))


def bin_recode(df: DataFrame, column: str, edges: Sequence[float], names: Sequence[str],
               name: str | None = None) -> DataFrame:
    """fixed bins, ``x <= edges[i]`` -> names[i], above the last -> names[-1]."""
    if len(names) != len(edges) + 1:
        raise ValueError("need one more name than edges")
    x = F.col(column)
    expr = F.when(x.isNull(), F.lit(None))
    for e, n in zip(edges, names):
        expr = expr.when(x <= F.lit(e), F.lit(n))
    return df.withColumn(name or f"{column}_group", expr.otherwise(F.lit(names[-1])))


def either_positive(df: DataFrame, label: str, prediction: str, name: str = "owner") -> DataFrame:
    """F16: 1 if the label or the prediction is positive, NULLs count as 0."""
    v = F.greatest(F.coalesce(F.col(label), F.lit(0)), F.coalesce(F.col(prediction), F.lit(0)))
    return df.withColumn(name, (v > 0).cast("int"))


def flag_known(pairs: DataFrame, train: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
    """add ``user_known`` / ``item_known``: does the id occur in train?

    Distinct train ids are an aggregate; the joins are left joins on one key
    each (AQE picks broadcast when the id tables are small)."""
    users = train.select(user).distinct().withColumn("user_known", F.lit(True))
    items = train.select(item).distinct().withColumn("item_known", F.lit(True))
    return (pairs.join(users, user, "left").join(items, item, "left")
            .withColumn("user_known", F.coalesce("user_known", F.lit(False)))
            .withColumn("item_known", F.coalesce("item_known", F.lit(False))))


def fill_missing(df: DataFrame, column: str, value) -> DataFrame:
    """Constant for rows the model could not score."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def clip_upper(df: DataFrame, column: str, upper: float) -> DataFrame:
    """upper bound only, as in the reference."""
    return df.withColumn(column, F.least(F.col(column), F.lit(float(upper))))


def append_latest(base: DataFrame, new: DataFrame, keys: Sequence[str], version: str = "_v") -> DataFrame:
    """Union of ratings where a new row replaces an old one with the
    same key (latest wins). ``max_by`` keeps it one hash aggregate."""
    b = base.withColumn(version, F.lit(0))
    n = new.select(*base.columns).withColumn(version, F.lit(1))
    u = b.unionByName(n)
    others = [c for c in base.columns if c not in keys]
    agg = [F.max_by(F.col(c), F.col(version)).alias(c) for c in others]
    return u.groupBy(*keys).agg(*agg)


def common(df: DataFrame, other: DataFrame) -> DataFrame:
    """K7: set intersection (distinct rows in both), a left-semi join."""
    return df.intersect(other)
