"""Statistics and classifier-evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import clean as CL
from kiln.operators import stats as ST
from kiln.plans.registry import query
from kiln.sources import views as V

NUM_COLS = ["n_orders", "order_total", "avg_order", "tenure"]
CORR_COLS = ["n_orders", "order_total", "tenure", "churned"]


def _long_sql(cols, extra=""):
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value{extra} FROM v_customers" for c in cols)


def _ks_sf_sql(lam: str) -> str:
    return (f"CASE WHEN {lam} <= 0 THEN CAST(1 AS DOUBLE) ELSE least(CAST(1 AS DOUBLE), greatest(CAST(0 AS DOUBLE), "
            f"2 * list_sum(list_transform(range(1, 101), lambda j: pow(CAST(-1 AS DOUBLE), j - 1) "
            f"* exp(CAST(-2 AS DOUBLE) * j * j * {lam} * {lam}))))) END")


@query("ks_two_sample", f"""
WITH long AS ({_long_sql(NUM_COLS, ", churned")}),
per AS (SELECT feature, value, CAST(count_if(churned = 0) AS BIGINT) AS c0, CAST(count_if(churned = 1) AS BIGINT) AS c1
        FROM long WHERE value IS NOT NULL GROUP BY feature, value),
cum AS (SELECT feature, value,
               sum(c0) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS k0,
               sum(c1) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS k1,
               sum(c0) OVER (PARTITION BY feature) AS n0,
               sum(c1) OVER (PARTITION BY feature) AS n1
        FROM per),
d AS (SELECT feature, n0, n1, max(abs(CAST(k0 AS DOUBLE) / n0 - CAST(k1 AS DOUBLE) / n1)) AS d
      FROM cum GROUP BY feature, n0, n1),
l AS (SELECT *, sqrt(CAST(n0 * n1 AS DOUBLE) / CAST(n0 + n1 AS DOUBLE)) * d AS lam FROM d)
SELECT feature, round(d, 6) AS d, CAST(n0 AS BIGINT) AS n0, CAST(n1 AS BIGINT) AS n1,
       round({_ks_sf_sql('lam')}, 6) AS p
FROM l""")
def ks_two_sample(spark, sf):
    return ST.ks_two_sample(V.customers(spark, sf), NUM_COLS, "churned")


@query("pearson_with_label", "\nUNION ALL\n".join(
    f"SELECT CAST(count(*) AS BIGINT) AS n, '{c}' AS feature, "
    f"round(covar_pop(CAST({c} AS DOUBLE), CAST(churned AS DOUBLE)) / "
    f"nullif(stddev_pop(CAST({c} AS DOUBLE)) * stddev_pop(CAST(churned AS DOUBLE)), 0), 6) AS r FROM v_customers"
    for c in NUM_COLS))
def pearson_with_label(spark, sf):
    return ST.pearson_with(V.customers(spark, sf), NUM_COLS, "churned")


@query("corr_matrix_long", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(covar_pop(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) / "
    f"nullif(stddev_pop(CAST({a} AS DOUBLE)) * stddev_pop(CAST({b} AS DOUBLE)), 0), 6) AS r FROM v_customers"
    for a in CORR_COLS for b in CORR_COLS))
def corr_matrix_long(spark, sf):
    return ST.corr_matrix(V.customers(spark, sf), CORR_COLS)


@query("describe_numeric", f"""
WITH long AS ({_long_sql(NUM_COLS)})
SELECT feature, count(*) AS count, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std,
       min(value) AS min, max(value) AS max,
       round(quantile_cont(value, 0.25), 4) AS q25, round(quantile_cont(value, 0.5), 4) AS q50,
       round(quantile_cont(value, 0.75), 4) AS q75
FROM long WHERE value IS NOT NULL GROUP BY feature""")
def describe_numeric(spark, sf):
    # 4 places: values reach 1e5-1e6 and engines sum in different orders
    return ST.describe(V.customers(spark, sf), NUM_COLS, digits=4)


@query("median_by_class", f"""
WITH long AS ({_long_sql(NUM_COLS, ", churned")})
SELECT churned, feature, round(quantile_cont(value, 0.5), 6) AS median
FROM long WHERE value IS NOT NULL GROUP BY churned, feature""")
def median_by_class(spark, sf):
    return ST.class_medians(V.customers(spark, sf), NUM_COLS, "churned")


_CONF_SQL = """(SELECT CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp, CAST(count_if(label <> 1 AND prediction = 1) AS BIGINT) AS fp,
        CAST(count_if(label = 1 AND prediction <> 1) AS BIGINT) AS fn, CAST(count_if(label <> 1 AND prediction <> 1) AS BIGINT) AS tn
 FROM v_scored)"""


def _scores_sql(src: str) -> str:
    p = "CAST(tp AS DOUBLE) / nullif(tp + fp, 0)"
    r = "CAST(tp AS DOUBLE) / nullif(tp + fn, 0)"
    return f"""SELECT tp, fp, fn, tn,
       round(CAST(tp + tn AS DOUBLE) / nullif(tp + fp + fn + tn, 0), 6) AS accuracy,
       round({p}, 6) AS precision, round({r}, 6) AS recall,
       round(2 * {p} * {r} / nullif({p} + {r}, 0), 6) AS f1
FROM {src}"""


@query("confusion_matrix", f"SELECT * FROM {_CONF_SQL}")
def confusion_matrix(spark, sf):
    return ST.confusion(V.scored(spark, sf), "label", "prediction")


@query("binary_scores", _scores_sql(_CONF_SQL))
def binary_scores(spark, sf):
    return ST.binary_scores(ST.confusion(V.scored(spark, sf), "label", "prediction"))


@query("class_report", f"""
WITH c AS {_CONF_SQL},
s AS (SELECT 1 AS class, tp AS hit, fp AS false_pos, fn AS miss FROM c
      UNION ALL SELECT 0, tn, fn, fp FROM c)
SELECT CAST(class AS BIGINT) AS class,
       round(CAST(hit AS DOUBLE) / nullif(hit + false_pos, 0), 6) AS precision,
       round(CAST(hit AS DOUBLE) / nullif(hit + miss, 0), 6) AS recall,
       round(2 * (CAST(hit AS DOUBLE) / nullif(hit + false_pos, 0)) * (CAST(hit AS DOUBLE) / nullif(hit + miss, 0))
             / nullif(CAST(hit AS DOUBLE) / nullif(hit + false_pos, 0) + CAST(hit AS DOUBLE) / nullif(hit + miss, 0), 0), 6) AS f1,
       hit + miss AS support
FROM s""")
def class_report(spark, sf):
    return ST.class_report(ST.confusion(V.scored(spark, sf), "label", "prediction"))


@query("roc_points", """
WITH per AS (SELECT score, CAST(count_if(label = 1) AS BIGINT) AS pos, CAST(count_if(label <> 1) AS BIGINT) AS neg FROM v_scored GROUP BY score),
c AS (SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM per)
SELECT score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       round(CAST(tp AS DOUBLE) / nullif(P, 0), 6) AS tpr, round(CAST(fp AS DOUBLE) / nullif(N, 0), 6) AS fpr
FROM c""")
def roc_points(spark, sf):
    return ST.roc(V.scored(spark, sf), "label", "score")


def _auc_sql(score: str) -> str:
    return f"""
WITH per AS (SELECT CAST({score} AS DOUBLE) AS score, CAST(count_if(label = 1) AS BIGINT) AS pos, CAST(count_if(label <> 1) AS BIGINT) AS neg
             FROM v_scored GROUP BY 1),
c AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_neg FROM per)
SELECT round(sum(pos * (cum_neg - neg / CAST(2 AS DOUBLE))) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS auc,
       CAST(sum(pos) AS BIGINT) AS P, CAST(sum(neg) AS BIGINT) AS N
FROM c"""


@query("auc_rank", _auc_sql("score"))
def auc_rank(spark, sf):
    return ST.auc(V.scored(spark, sf), "label", "score")


@query("auc_hard", _auc_sql("prediction"))
def auc_hard(spark, sf):
    return ST.auc(V.scored(spark, sf), "label", "prediction")


_CURVE_SQL = """
WITH per AS (SELECT CAST({score} AS DOUBLE) AS score, CAST(count_if(label = 1) AS BIGINT) AS pos,
                    CAST(count_if(label <> 1) AS BIGINT) AS neg FROM v_scored GROUP BY 1),
c AS (SELECT score, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
             CAST(sum(pos) OVER () AS BIGINT) AS P, CAST(sum(neg) OVER () AS BIGINT) AS N
      FROM per WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""


def _pr_sql(score: str) -> str:
    return _CURVE_SQL.format(score=score) + """,
p AS (SELECT *, CAST(tp AS DOUBLE) / (tp + fp) AS here FROM c),
l AS (SELECT *, coalesce(lag(here) OVER (ORDER BY score DESC), here) AS before FROM p)
SELECT round(sum(pos * (here + before) / 2) / nullif(CAST(sum(pos) AS DOUBLE), 0), 6) AS pr_auc FROM l"""


@query("pr_auc", _pr_sql("score"))
def pr_auc(spark, sf):
    """Area under the precision-recall curve of the scored labels."""
    return ST.pr_area(V.scored(spark, sf), "label", "score")


@query("pr_auc_hard", _pr_sql("prediction"))
def pr_auc_hard(spark, sf):
    """The same of hard predictions."""
    return ST.pr_area(V.scored(spark, sf), "label", "prediction")


@query("score_thresholds", _CURVE_SQL.format(score="score") + """
SELECT score AS threshold, tp, fp, P - tp AS fn, N - fp AS tn,
       round(CAST(tp + N - fp AS DOUBLE) / nullif(P + N, 0), 6) AS accuracy,
       round(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 6) AS precision, round(CAST(tp AS DOUBLE) / nullif(P, 0), 6) AS recall,
       round(2 * (CAST(tp AS DOUBLE) / nullif(tp + fp, 0)) * (CAST(tp AS DOUBLE) / nullif(P, 0))
             / nullif(CAST(tp AS DOUBLE) / nullif(tp + fp, 0) + CAST(tp AS DOUBLE) / nullif(P, 0), 0), 6) AS f1
FROM c""")
def score_thresholds(spark, sf):
    """Confusion counts and scores at every distinct score."""
    return ST.score_thresholds(V.scored(spark, sf), "label", "score")


@query("threshold_sweep", """
WITH t AS (SELECT i * CAST(0.005 AS DOUBLE) AS threshold FROM range(0, 201) r(i)),
c AS (SELECT t.threshold,
             CAST(count_if(s.label = 1 AND s.score >= t.threshold) AS BIGINT) AS tp,
             CAST(count_if(s.label <> 1 AND s.score >= t.threshold) AS BIGINT) AS fp,
             CAST(count_if(s.label = 1 AND s.score < t.threshold) AS BIGINT) AS fn,
             CAST(count_if(s.label <> 1 AND s.score < t.threshold) AS BIGINT) AS tn
      FROM t, v_scored s GROUP BY t.threshold)
SELECT round(threshold, 6) AS threshold, tp, fp, fn, tn,
       round(CAST(tp + tn AS DOUBLE) / nullif(tp + fp + fn + tn, 0), 6) AS accuracy,
       round(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 6) AS precision,
       round(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 6) AS recall
FROM c""")
def threshold_sweep(spark, sf):
    return ST.threshold_sweep(V.scored(spark, sf), "label", "score", step=0.005)


@query("log_loss", """
WITH p AS (SELECT CAST(label AS DOUBLE) AS y,
                  least(greatest(score, CAST(1e-15 AS DOUBLE)), CAST(1 AS DOUBLE) - CAST(1e-15 AS DOUBLE)) AS p
           FROM v_scored)
SELECT round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS log_loss, count(*) AS n FROM p""")
def log_loss(spark, sf):
    return ST.log_loss(V.scored(spark, sf), "label", "score")


@query("rmse_baselines", """
WITH t AS (SELECT user_id, item_id, rating FROM v_ratings_test),
im AS (SELECT item_id, avg(rating) AS mean FROM v_ratings_train GROUP BY item_id),
g AS (SELECT avg(rating) AS mean FROM v_ratings_train),
p AS (SELECT 'item_mean' AS model, t.rating,
             least(coalesce(im.mean, CAST(3.7 AS DOUBLE)), CAST(5 AS DOUBLE)) AS pred
      FROM t LEFT JOIN im ON t.item_id = im.item_id
      UNION ALL
      SELECT 'global_mean', t.rating, g.mean FROM t, g)
SELECT model, round(sqrt(avg((rating - pred) * (rating - pred))), 6) AS rmse, count(*) AS n
FROM p GROUP BY model""")
def rmse_baselines(spark, sf):
    test = V.ratings_test(spark, sf).select("user_id", "item_id", "rating")
    train = V.ratings_train(spark, sf)
    im = train.groupBy("item_id").agg(F.avg("rating").alias("pred"))
    item_pred = CL.clip_upper(CL.fill_missing(test.join(im, "item_id", "left"), "pred", 3.7), "pred", 5.0)
    g = train.agg(F.avg("rating")).scalar()
    glob = test.withColumn("pred", g)
    both = (item_pred.select(F.lit("item_mean").alias("model"), "rating", "pred")
            .unionByName(glob.select(F.lit("global_mean").alias("model"), "rating", "pred")))
    return ST.rmse(both, "rating", "pred", by=["model"])


@query("truth_vs_baseline", """
SELECT t.user_id, t.item_id, t.rating, round(im.mean, 6) AS pred, round(t.rating - im.mean, 6) AS err
FROM v_ratings_test t
JOIN (SELECT item_id, avg(rating) AS mean FROM v_ratings_train GROUP BY item_id) im ON t.item_id = im.item_id""")
def truth_vs_baseline(spark, sf):
    """Predictions joined to the truth on the two-part key (user, item)."""
    test = V.ratings_test(spark, sf).select("user_id", "item_id", "rating")
    train = V.ratings_train(spark, sf)
    pairs = test.select("user_id", "item_id").join(train.groupBy("item_id").agg(F.avg("rating").alias("mean")), "item_id")
    j = test.join(pairs, ["user_id", "item_id"])
    return j.select("user_id", "item_id", "rating", F.round("mean", 6).alias("pred"),
                    F.round(F.col("rating") - F.col("mean"), 6).alias("err"))


@query("pearson_p")
def pearson_p(spark, sf):
    """R, t and two-sided p per feature (p from the incomplete beta)."""
    return ST.pearson_p(V.customers(spark, sf), NUM_COLS, "churned")


@query("pearson_t", "\nUNION ALL\n".join(f"""
SELECT '{c}' AS feature, n, round(r, 4) AS r, round(r * sqrt((n - 2) / nullif(1 - r * r, 0)), 4) AS t
FROM (SELECT count(*) AS n, round(corr(CAST({c} AS DOUBLE), CAST(churned AS DOUBLE)), 12) AS r FROM v_customers)""" for c in NUM_COLS))
def pearson_t(spark, sf):
    """T3 without its p value, which SQL cannot state: r, n and t per feature."""
    return ST.pearson_p(V.customers(spark, sf), NUM_COLS, "churned").select("feature", "n", "r", "t")
