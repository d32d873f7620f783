"""Statistics and evaluation.

Everything ordered (KS, ROC, AUC, quantiles) first aggregates to one row per
distinct value and then uses the distributed running total of
``kiln.operators.prefix`` -- never a window over the whole table. Constant
columns give NULL correlations instead of the DIVIDE_BY_ZERO that ``corr``
raises under ANSI mode.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions.columns import safe_div
from kiln.operators.prefix import rows_at, running_sum
from kiln.operators.report import unpivot_str


def _long_numeric(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    cast = df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features])
    return cast.unpivot(list(keep), list(features), "feature", "value").filter(F.col("value").isNotNull())


# ---- correlation ---------------------------------------------------------------------

def safe_corr(a, b) -> Column:
    """Pearson r as covar_pop / (std_pop * std_pop); NULL on zero variance."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    den = F.stddev_pop(a) * F.stddev_pop(b)
    return F.try_divide(F.covar_pop(a, b), F.when(den != 0, den))


def pearson_with(df: DataFrame, features: Sequence[str], label: str, digits: int = 6) -> DataFrame:
    """R of every feature with the label, all in one aggregate, long form."""
    row = df.agg(*[F.round(safe_corr(F.col(f).cast("double"), F.col(label).cast("double")), digits).alias(f)
                   for f in features], F.count(F.lit(1)).alias("_n"))
    return row.unpivot(["_n"], list(features), "feature", "r").withColumnRenamed("_n", "n")


def _t_two_sided_p(r: pd.Series, n: pd.Series) -> pd.Series:
    """Two-sided p of Pearson r with n pairs, from the regularised incomplete
    beta I_x(df/2, 1/2), x = df / (df + t^2). Continued fraction (Lentz)."""
    import numpy as np

    def betacf(a, b, x):
        tiny, eps = 1e-300, 3e-16
        qab, qap, qam = a + b, a + 1.0, a - 1.0
        c, d = 1.0, 1.0 - qab * x / qap
        d = tiny if abs(d) < tiny else d
        d = 1.0 / d
        h = d
        for m in range(1, 300):
            m2 = 2 * m
            aa = m * (b - m) * x / ((qam + m2) * (a + m2))
            d = 1.0 + aa * d
            d = tiny if abs(d) < tiny else d
            c = 1.0 + aa / c
            c = tiny if abs(c) < tiny else c
            d = 1.0 / d
            h *= d * c
            aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
            d = 1.0 + aa * d
            d = tiny if abs(d) < tiny else d
            c = 1.0 + aa / c
            c = tiny if abs(c) < tiny else c
            d = 1.0 / d
            de = d * c
            h *= de
            if abs(de - 1.0) < eps:
                break
        return h

    def ibeta(a, b, x):
        if x <= 0:
            return 0.0
        if x >= 1:
            return 1.0
        lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
        if x < (a + 1) / (a + b + 2):
            return math.exp(lbt) * betacf(a, b, x) / a
        return 1.0 - math.exp(lbt) * betacf(b, a, 1 - x) / b

    out = []
    for rv, nv in zip(r, n):
        if rv is None or nv is None or (isinstance(rv, float) and np.isnan(rv)) or nv < 3:
            out.append(None)
            continue
        dfree = nv - 2.0
        if abs(rv) >= 1.0:
            out.append(0.0)
            continue
        t2 = rv * rv * dfree / (1.0 - rv * rv)
        out.append(ibeta(dfree / 2.0, 0.5, dfree / (dfree + t2)))
    return pd.Series(out, dtype="float64")


def pearson_p(df: DataFrame, features: Sequence[str], label: str, digits: int = 4) -> DataFrame:
    """R, t and two-sided p per feature, rounded, sorted by |r|. The p
    value is a pandas UDF on the one-row-per-feature result only."""
    r = pearson_with(df, features, label, digits=12)
    p_udf = F.pandas_udf(_t_two_sided_p, "double")
    t = F.col("r") * F.sqrt((F.col("n") - 2) / F.when(F.col("r") * F.col("r") < 1, 1 - F.col("r") * F.col("r")))
    return (r.withColumn("t", F.round(t, digits)).withColumn("p", F.round(p_udf("r", "n"), digits))
            .withColumn("r", F.round("r", digits)).orderBy(F.desc(F.abs("r")), "feature"))


def corr_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """T4: every ordered pair (a, b) with its r, from one aggregate."""
    pairs = [(a, b) for a in cols for b in cols]
    row = df.agg(*[F.round(safe_corr(F.col(a).cast("double"), F.col(b).cast("double")), digits).alias(f"{a}|{b}")
                   for a, b in pairs])
    long = row.unpivot([], [f"`{a}|{b}`" for a, b in pairs], "pair", "r")
    return long.select(F.split("pair", r"\|").getItem(0).alias("a"), F.split("pair", r"\|").getItem(1).alias("b"), "r")


# ---- distribution tests ----------------------------------------------------------------

def ks_lambda_sf(lam: Column, terms: int = 100) -> Column:
    """Survival function of the Kolmogorov distribution,
    Q(l) = 2 * sum_{j>=1} (-1)^(j-1) exp(-2 j^2 l^2), clipped to [0, 1]."""
    s = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
                    lambda acc, j: acc + F.pow(F.lit(-1.0), j - 1) * F.exp(F.lit(-2.0) * j * j * lam * lam))
    return F.when(lam <= 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * s)))


def ks_two_sample(df: DataFrame, features: Sequence[str], cls: str, digits: int = 6) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov D per feature between class 0 and 1,
    with the asymptotic p value (Q(sqrt(n0 n1 / (n0 + n1)) * D)).

    Unpivot once; per (feature, value) count each class; running totals per
    feature give both empirical CDFs at every distinct value."""
    long = _long_numeric(df, features, keep=[cls])
    per = (long.groupBy("feature", "value")
           .agg(F.count_if(F.col(cls) == 0).alias("c0"), F.count_if(F.col(cls) == 1).alias("c1")))
    cum = running_sum(per, ["value"], ["c0", "c1"], keys=["feature"])
    tot = per.groupBy("feature").agg(F.sum("c0").alias("n0"), F.sum("c1").alias("n1"))
    d = (cum.join(tot, "feature")
         .withColumn("gap", F.abs(safe_div("cum_c0", "n0") - safe_div("cum_c1", "n1")))
         .groupBy("feature", "n0", "n1").agg(F.max("gap").alias("d")))
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    en = F.sqrt(n0 * n1 / (n0 + n1))
    # p from the unrounded D (a same-select alias named d would shadow it)
    p = d.withColumn("p", F.round(ks_lambda_sf(en * F.col("d")), digits))
    return p.select("feature", F.round("d", digits).alias("d"), "n0", "n1", "p")


# ---- quantiles ----------------------------------------------------------------------

def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolation quantiles (position p * (n - 1)) per key.

    Distinct values with counts -> order buckets; only buckets that hold a
    target position are sorted, and each of their rows checks which positions
    it covers. No group ever holds its values in one buffer (unlike the
    ``percentile`` aggregate)."""
    keys = list(keys)
    per = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
    tot = per.groupBy(*keys).agg(F.sum("c").alias("_n"))
    probs_arr = F.array(*[F.lit(float(p)) for p in probs])
    at = F.flatten(F.transform(probs_arr, lambda p: F.array(F.floor(p * (F.col("_n") - 1)), F.ceil(p * (F.col("_n") - 1)))))
    cum = rows_at(per, [value], "c", tot.select(*keys, at.alias("_at")), keys=keys)
    j = cum.join(tot, keys) if keys else cum.withColumn("_n", tot.select("_n").scalar())
    j = j.withColumn("_p", F.explode(probs_arr))
    pos = F.col("_p") * (F.col("_n") - 1)
    lo, hi = F.floor(pos), F.ceil(pos)
    start, end = F.col("cum_c") - F.col("c"), F.col("cum_c")
    hit_lo = (lo >= start) & (lo < end)
    hit_hi = (hi >= start) & (hi < end)
    cand = j.filter(hit_lo | hit_hi).select(
        *keys, "_p", (pos - lo).alias("_frac"),
        F.when(hit_lo, F.col(value)).alias("_vlo"), F.when(hit_hi, F.col(value)).alias("_vhi"))
    q = cand.groupBy(*keys, "_p").agg(F.max("_vlo").alias("_vlo"), F.max("_vhi").alias("_vhi"),
                                      F.max("_frac").alias("_frac"))
    return q.select(*keys, F.col("_p").alias("p"),
                    (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")).alias("q"))


def describe(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % and max per column."""
    long = _long_numeric(df, cols)
    basic = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("count"), F.round(F.avg("value"), digits).alias("mean"),
        F.round(F.stddev_samp("value"), digits).alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], keys=["feature"])
    qw = q.groupBy("feature").agg(*[F.round(F.max(F.when(F.col("p") == p, F.col("q"))), digits).alias(name)
                                    for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    return basic.join(qw, "feature")


def class_medians(df: DataFrame, cols: Sequence[str], cls: str, digits: int = 6) -> DataFrame:
    """Median of each column per class, long form (class, feature, median)."""
    long = _long_numeric(df, cols, keep=[cls])
    q = exact_quantiles(long, "value", [0.5], keys=[cls, "feature"])
    return q.select(cls, "feature", F.round("q", digits).alias("median"))


# ---- classifier evaluation -----------------------------------------------------------

def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """M9: tp, fp, fn, tn in one pass (the reference ran four count jobs)."""
    y, p = F.col(label) == 1, F.col(pred) == 1
    return df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                  F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))


def binary_scores(conf: DataFrame, digits: int = 6) -> DataFrame:
    """Accuracy, precision, recall, F1 from a confusion row; NULL on a
    zero divisor."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    prec, rec = safe_div(tp, tp + fp), safe_div(tp, tp + fn)
    return conf.select(*conf.columns,
                       F.round(safe_div(tp + tn, tp + fp + fn + tn), digits).alias("accuracy"),
                       F.round(prec, digits).alias("precision"), F.round(rec, digits).alias("recall"),
                       F.round(F.try_divide(2 * prec * rec, prec + rec), digits).alias("f1"))


def class_report(conf: DataFrame, digits: int = 6) -> DataFrame:
    """Per class precision, recall, F1 and support."""
    rows = conf.selectExpr("stack(2, 1, tp, fp, fn, 0, tn, fn, fp) AS (class, hit, false_pos, miss)")
    prec = safe_div("hit", F.col("hit") + F.col("false_pos"))
    rec = safe_div("hit", F.col("hit") + F.col("miss"))
    return rows.select(F.col("class").cast("long").alias("class"),
                       F.round(prec, digits).alias("precision"), F.round(rec, digits).alias("recall"),
                       F.round(F.try_divide(2 * prec * rec, prec + rec), digits).alias("f1"),
                       (F.col("hit") + F.col("miss")).alias("support"))


def _score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    return (df.groupBy(F.col(score).cast("double").alias("score"))
            .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")))


def roc(df: DataFrame, label: str, score: str, digits: int = 6) -> DataFrame:
    """One ROC point per distinct score (threshold: score >= t),
    from running totals taken from the highest score down."""
    per = _score_counts(df, label, score)
    cum = running_sum(per, [-F.col("score")], ["pos", "neg"])
    tot = per.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    P, N = tot.select("P").scalar(), tot.select("N").scalar()
    return cum.select(F.col("score").alias("threshold"), F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                      F.round(F.try_divide(F.col("cum_pos"), P.cast("double")), digits).alias("tpr"),
                      F.round(F.try_divide(F.col("cum_neg"), N.cast("double")), digits).alias("fpr"))


def auc(df: DataFrame, label: str, score: str, digits: int = 6) -> DataFrame:
    """ROC AUC = P(score_pos > score_neg) + P(tie) / 2, the rank-sum
    form with ties, exact."""
    per = _score_counts(df, label, score)
    cum = running_sum(per, ["score"], ["neg"])
    agg = cum.agg(F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2.0)).alias("_s"),
                  F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return agg.select(F.round(F.try_divide(F.col("_s"), F.col("P").cast("double") * F.col("N")), digits).alias("auc"), "P", "N")


def score_thresholds(df: DataFrame, label: str, score: str, digits: int = 6) -> DataFrame:
    """Confusion counts and scores at every distinct score (positive
    when score >= threshold)."""
    per = _score_counts(df, label, score)
    cum = running_sum(per, [-F.col("score")], ["pos", "neg"])
    tot = per.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    P, N = tot.select("P").scalar(), tot.select("N").scalar()
    c = cum.select(F.col("score").alias("threshold"), F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"))
    c = c.withColumn("fn", P - F.col("tp")).withColumn("tn", N - F.col("fp"))
    return binary_scores(c, digits)


def pr_area(df: DataFrame, label: str, score: str, digits: int = 6) -> DataFrame:
    """Area under the precision-recall curve over all distinct
    scores, by trapezoids; the curve begins at recall 0 with the precision of
    the highest score. A row's predecessor on the curve is its running count
    less its own."""
    cum = running_sum(_score_counts(df, label, score), [-F.col("score")], ["pos", "neg"])
    tp, fp = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    here = tp / (tp + fp)
    before = F.when(tp0 + fp0 > 0, F.try_divide(tp0, tp0 + fp0)).otherwise(here)
    area = F.sum(F.col("pos") * (here + before) / 2.0)
    return cum.agg(F.round(F.try_divide(area, F.sum("pos").cast("double")), digits).alias("pr_auc"))


def threshold_sweep(df: DataFrame, label: str, score: str, step: float = 0.005, digits: int = 6) -> DataFrame:
    """Confusion counts and scores at thresholds 0, step, ..., 1
    (positive when score >= t). Each row goes to the bucket of the largest
    threshold it reaches; counts then accumulate over at most 1/step + 1
    buckets, a small table."""
    k = int(round(1.0 / step))
    s = F.col(score).cast("double")
    b0 = F.floor(s / F.lit(step)).cast("long")
    b = (F.when((b0 + 1) * F.lit(step) <= s, b0 + 1).when(b0 * F.lit(step) > s, b0 - 1).otherwise(b0))
    b = F.least(F.lit(k), b)
    per = (df.withColumn("_b", b).filter(F.col("_b") >= 0).groupBy("_b")
           .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")))
    grid = df.sparkSession.range(k + 1).select(F.col("id").alias("_b"))
    g = grid.join(per, "_b", "left").fillna(0, ["pos", "neg"])
    down = Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, 0)  # <= k+1 rows
    tot = df.agg(F.count_if(F.col(label) == 1).alias("P"), F.count_if(F.col(label) != 1).alias("N"))
    P, N = tot.select("P").scalar(), tot.select("N").scalar()
    c = g.select((F.col("_b") * F.lit(step)).alias("threshold"),
                 F.sum("pos").over(down).alias("tp"), F.sum("neg").over(down).alias("fp"))
    c = c.withColumn("fn", P - F.col("tp")).withColumn("tn", N - F.col("fp"))
    return binary_scores(c, digits).select(F.round("threshold", 6).alias("threshold"), "tp", "fp", "fn", "tn",
                                           "accuracy", "precision", "recall")


def log_loss(df: DataFrame, label: str, prob: str, eps: float = 1e-15, digits: int = 6) -> DataFrame:
    """Mean binary log loss with probabilities clipped to [eps, 1-eps]."""
    p = F.least(F.greatest(F.col(prob).cast("double"), F.lit(eps)), F.lit(1 - eps))
    y = F.col(label).cast("double")
    return df.agg(F.round(F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))), digits).alias("log_loss"),
                  F.count(F.lit(1)).alias("n"))


def rmse(df: DataFrame, y: str, pred: str, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Root mean squared error (optionally per group)."""
    e = F.col(y) - F.col(pred)
    return df.groupBy(*by).agg(F.round(F.sqrt(F.avg(e * e)), digits).alias("rmse"), F.count(F.lit(1)).alias("n"))
