"""Report queries on the canonical views (A, J, K families)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import columns as C
from kiln.operators import clean as CL
from kiln.operators import report as R
from kiln.plans.registry import query
from kiln.session import stored
from kiln.sources import views as V
from kiln.sources.tables import load

# Fixed parameters of the fixture queries (FIXTURES.md section 3).
DOWNTOWN = (-122.401818, 37.795037)
DOWNTOWN_R2 = 0.0025
HOUR_DAYS = ("2024-01-05", "2024-01-12", "2024-01-19")
RADIUS_SQL = ("(x - CAST(-122.401818 AS DOUBLE)) * (x - CAST(-122.401818 AS DOUBLE)) + "
              "(y - CAST(37.795037 AS DOUBLE)) * (y - CAST(37.795037 AS DOUBLE))")


@query("resolution_share", """
SELECT category, count(*) AS total,
       CAST(count_if(trim(resolution) = 'NONE') AS BIGINT) AS n_none,
       round(CAST(CAST(count_if(trim(resolution) = 'NONE') AS BIGINT) AS DOUBLE) * 100 / count(*), 4) AS none_pct,
       round(CAST(count(*) - CAST(count_if(trim(resolution) = 'NONE') AS BIGINT) AS DOUBLE) * 100 / count(*), 4) AS resolved_pct
FROM v_incidents GROUP BY category""")
def resolution_share(spark, sf):
    inc = V.incidents(spark, sf)
    out = R.conditional_share(inc, "category", F.trim("resolution") == "NONE", matched="n_none")
    return (out.withColumnRenamed("n_none_pct", "none_pct")
            .withColumn("resolved_pct", C.pct(F.col("total") - F.col("n_none"), "total")))


@query("count_by_category", "SELECT category, count(*) AS n FROM v_incidents GROUP BY category")
def count_by_category(spark, sf):
    return R.counts(V.incidents(spark, sf), "category")


@query("top10_categories", """
SELECT district, category, count(*) AS n FROM v_incidents
GROUP BY district, category ORDER BY n DESC, district, category LIMIT 10""")
def top10_categories(spark, sf):
    c = R.counts(V.incidents(spark, sf), ["district", "category"])
    return R.top_n(c, [F.desc("n"), "district", "category"], 10)


@query("radius_filter", f"""
SELECT incident_id, x, y, round({RADIUS_SQL}, 9) AS sq_dist
FROM v_incidents WHERE {RADIUS_SQL} < CAST(0.0025 AS DOUBLE)""")
def radius_filter(spark, sf):
    inc = V.incidents(spark, sf)
    near = CL.within_radius(inc, "x", "y", *DOWNTOWN, DOWNTOWN_R2)
    return near.select("incident_id", "x", "y", F.round("sq_dist", 9).alias("sq_dist"))


@query("downtown_by_day", f"""
SELECT day_of_week, count(*) AS n FROM v_incidents
WHERE {RADIUS_SQL} < CAST(0.0025 AS DOUBLE) GROUP BY day_of_week""")
def downtown_by_day(spark, sf):
    inc = V.incidents(spark, sf)
    return R.counts(inc, "day_of_week", where=C.sq_dist("x", "y", *DOWNTOWN) < DOWNTOWN_R2)


@query("best_worst_days", """
(SELECT CAST(strptime(date_text, '%m/%d/%Y') AS DATE) AS date, count(*) AS n, 'top' AS "end"
 FROM v_incidents GROUP BY 1 ORDER BY n DESC, date LIMIT 20)
UNION ALL
(SELECT CAST(strptime(date_text, '%m/%d/%Y') AS DATE) AS date, count(*) AS n, 'bottom' AS "end"
 FROM v_incidents GROUP BY 1 ORDER BY n ASC, date LIMIT 20)""")
def best_worst_days(spark, sf):
    inc = V.incidents(spark, sf).select(C.parse_date("date_text").alias("date"))
    per_day = inc.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return R.top_and_bottom(per_day, "n", "date", 20)


@query("count_by_month", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month,
       count(*) AS n
FROM orders GROUP BY 1, 2""")
def count_by_month(spark, sf):
    o = load(spark, sf, "orders")
    return R.counts(o.select(F.year("o_orderdate").cast("long").alias("year"),
                             F.month("o_orderdate").cast("long").alias("month")), ["year", "month"])


@query("count_by_hour", f"""
SELECT CAST(strptime(date_text, '%m/%d/%Y') AS DATE) AS date,
       CAST(hour(strptime(time_text, '%H:%M')) AS BIGINT) AS hour, count(*) AS n
FROM v_incidents
WHERE CAST(strptime(date_text, '%m/%d/%Y') AS DATE) IN ({", ".join(f"DATE '{d}'" for d in HOUR_DAYS)})
GROUP BY 1, 2""")
def count_by_hour(spark, sf):
    inc = V.incidents(spark, sf).select(C.parse_date("date_text").alias("date"),
                                        C.parse_hour("time_text").cast("long").alias("hour"))
    days = [F.to_date(F.lit(d)) for d in HOUR_DAYS]
    return R.counts(inc, ["date", "hour"], where=F.col("date").isin(*days))


@query("top3_detail", """
WITH top AS (SELECT district FROM v_incidents GROUP BY district
             ORDER BY count(*) DESC, district LIMIT 3)
SELECT district, CAST(hour(strptime(time_text, '%H:%M')) AS BIGINT) AS hour, category, count(*) AS n
FROM v_incidents WHERE district IN (SELECT district FROM top)
GROUP BY 1, 2, 3""")
def top3_detail(spark, sf):
    inc = V.incidents(spark, sf).withColumn("hour", C.parse_hour("time_text").cast("long"))
    return R.detail_of_top(inc, "district", 3, ["hour", "category"])


@query("item_rating_stats", """
SELECT item_id, count(*) AS n, round(sum(rating), 6) AS total, round(avg(rating), 6) AS mean
FROM v_ratings_train GROUP BY item_id""")
def item_rating_stats(spark, sf):
    return R.rating_stats(V.ratings_train(spark, sf), "item_id")


@query("user_rating_stats", """
SELECT user_id, count(*) AS n, round(sum(rating), 6) AS total, round(avg(rating), 6) AS mean
FROM v_ratings_train GROUP BY user_id""")
def user_rating_stats(spark, sf):
    return R.rating_stats(V.ratings_train(spark, sf), "user_id")


@query("loo_user_mean", """
SELECT r.user_id, r.item_id, r.rating,
       round(CASE WHEN s.n > 1 THEN (s.s - r.rating) / (s.n - 1) ELSE CAST(0 AS DOUBLE) END, 6) AS loo_mean
FROM v_ratings_train r
JOIN (SELECT user_id, sum(rating) AS s, count(*) AS n FROM v_ratings_train GROUP BY user_id) s
  ON r.user_id = s.user_id""")
def loo_user_mean(spark, sf):
    return R.loo_mean(V.ratings_train(spark, sf))


@query("clicks_by_hour", """
SELECT hour_code, CAST(sum(click) AS BIGINT) AS clicks, count(*) AS n
FROM v_impressions GROUP BY hour_code""")
def clicks_by_hour(spark, sf):
    return (V.impressions(spark, sf).groupBy("hour_code")
            .agg(F.sum("click").alias("clicks"), F.count(F.lit(1)).alias("n")))


@query("crosstab_feature", """
SELECT banner_pos AS value, CAST(count_if(click = 0) AS BIGINT) AS click_0, CAST(count_if(click = 1) AS BIGINT) AS click_1
FROM v_impressions GROUP BY banner_pos""")
def crosstab_feature(spark, sf):
    return R.crosstab(V.impressions(spark, sf), "banner_pos", "click", [0, 1])


CTR_FEATURES = ["c1", "banner_pos", "site_category"]


@query("feature_ctr", "\nUNION ALL\n".join(
    f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS value, count(*) AS n, round(avg(click), 6) AS rate "
    f"FROM v_impressions GROUP BY {f}" for f in CTR_FEATURES))
def feature_ctr(spark, sf):
    return R.rate_by_value(V.impressions(spark, sf), CTR_FEATURES, "click")


NUNIQUE_COLS = ["c1", "banner_pos", "site_id", "site_category", "device_id", "hour_code"]


@query("nunique_columns", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM v_impressions" for c in NUNIQUE_COLS))
def nunique_columns(spark, sf):
    return R.distinct_counts(V.impressions(spark, sf), NUNIQUE_COLS)


NULL_COLS = ["segment", "avg_order", "first_order", "total_charge_num"]
_CUST_NUM = """(SELECT *, TRY_CAST(nullif(trim(total_charge), '') AS DOUBLE) AS total_charge_num
               FROM v_customers)"""


@query("null_counts", "\nUNION ALL\n".join(
    [f"SELECT '{c}' AS \"column\", CAST(count_if({c} IS NULL) AS BIGINT) AS n_null FROM {_CUST_NUM}" for c in NULL_COLS]
    + ["SELECT '_total' AS \"column\", " + " + ".join(f"CAST(count_if({c} IS NULL) AS BIGINT)" for c in NULL_COLS)
       + f" AS n_null FROM {_CUST_NUM}"]))
def null_counts(spark, sf):
    cust = V.customers(spark, sf).withColumn("total_charge_num", C.to_number("total_charge"))
    return R.null_counts(cust, NULL_COLS)


MEAN_COLS = ["n_orders", "order_total", "avg_order", "tenure"]


@query("mean_by_class", "SELECT churned, " + ", ".join(
    f"round(avg({c}), 6) AS mean_{c}" for c in MEAN_COLS) + " FROM v_customers GROUP BY churned")
def mean_by_class(spark, sf):
    return R.class_means(V.customers(spark, sf), MEAN_COLS, "churned")


@query("share_by_value", """
SELECT segment, count(*) AS n,
       round(CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM v_customers), 6) AS pct
FROM v_customers GROUP BY segment""")
def share_by_value(spark, sf):
    return R.shares(V.customers(spark, sf), "segment")


@query("share_within_class", """
SELECT churned, segment, count(*) AS n,
       round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (PARTITION BY churned), 6) AS pct
FROM v_customers GROUP BY churned, segment""")
def share_within_class(spark, sf):
    return R.shares_within(V.customers(spark, sf), "segment", "churned")


@query("audience_by_creator", """
SELECT creator_name, count(DISTINCT userid) AS users FROM v_comments GROUP BY creator_name""")
def audience_by_creator(spark, sf):
    return R.audience(V.comments(spark, sf), "creator_name", "userid")


SKETCH_ERROR = 0.03  # over three standard errors of a sketch


@query("audience_sketch", """
SELECT category, CAST(month(ts) AS INTEGER) AS month, count(DISTINCT user_id) AS users, true AS within
FROM (SELECT event_type AS category, ts, user_id FROM events) GROUP BY 1, 2""")
def audience_sketch(spark, sf):
    """Users per category and day as stored sketches, merged into
    months; ``within`` tells whether the merged estimate lies within 3 % of the
    exact count, which stands beside it."""
    ev = load(spark, sf, "events").select(F.col("event_type").alias("category"), F.month("ts").alias("month"),
                                          F.to_date("ts").alias("day"), "user_id")
    days = stored(R.distinct_sketches(ev, ["category", "month", "day"], "user_id"), "audience-days")
    months = R.sketch_counts(R.merge_sketches(days, ["category", "month"]), "estimate")
    exact = ev.select("category", "month", "user_id").distinct().groupBy("category", "month").agg(F.count(F.lit(1)).alias("users"))
    return exact.join(months, ["category", "month"]).select(
        "category", "month", "users", (F.abs(F.col("estimate") - F.col("users")) <= SKETCH_ERROR * F.col("users")).alias("within"))


CREATOR_POSITIVE = r"\bthe\b"


@query("creator_share_z", r"""
WITH pu AS (SELECT creator_name, userid, max(CAST(regexp_matches(comment, '\bthe\b') AS INTEGER)) AS pos
            FROM v_comments GROUP BY creator_name, userid),
     g AS (SELECT creator_name, count(*) AS users, CAST(sum(pos) AS BIGINT) AS positive FROM pu GROUP BY creator_name),
     t AS (SELECT sum(users) AS u, sum(positive) AS p FROM g)
SELECT creator_name, users, positive,
       round(CAST(positive AS DOUBLE) / users, 6) AS share,
       round((CAST(positive AS DOUBLE) / users - CAST(t.p - positive AS DOUBLE) / (t.u - users))
             / nullif(sqrt((CAST(t.p AS DOUBLE) / t.u) * (1 - CAST(t.p AS DOUBLE) / t.u)
                           * (CAST(1 AS DOUBLE) / users + CAST(1 AS DOUBLE) / (t.u - users))), 0), 6) AS z
FROM g, t WHERE users >= 5""")
def creator_share_z(spark, sf):
    com = V.comments(spark, sf)
    return R.audience_share(com, "creator_name", "userid", F.col("comment").rlike(CREATOR_POSITIVE), min_users=5)


@query("histogram_by_class", """
WITH m AS (SELECT min(order_total) AS lo, max(order_total) AS hi FROM v_customers),
     b AS (SELECT churned, CAST(least(9, floor(coalesce((order_total - lo) * 10 / nullif(hi - lo, 0), 0))) AS INTEGER) AS bin
           FROM v_customers, m WHERE order_total IS NOT NULL),
     c AS (SELECT churned, bin, count(*) AS n FROM b GROUP BY churned, bin)
SELECT c.churned, c.bin, c.n,
       round(m.lo + c.bin * ((m.hi - m.lo) / CAST(10 AS DOUBLE)), 6) AS lo,
       round(m.lo + (c.bin + 1) * ((m.hi - m.lo) / CAST(10 AS DOUBLE)), 6) AS hi,
       round(CAST(c.n AS DOUBLE) * 100 / sum(c.n) OVER (PARTITION BY c.churned), 6) AS pct
FROM c, m""")
def histogram_by_class(spark, sf):
    return R.histogram(V.customers(spark, sf), "order_total", 10, cls="churned")


@query("long_text_count", """
SELECT CAST(count_if(length(plot) >= 2000) AS BIGINT) AS n_long, count(*) AS n FROM v_movies""")
def long_text_count(spark, sf):
    m = V.movies(spark, sf)
    return m.agg(F.count_if(F.length("plot") >= 2000).alias("n_long"), F.count(F.lit(1)).alias("n"))


@query("base_rate", "SELECT round(avg(churned), 6) AS rate, count(*) AS n FROM v_customers")
def base_rate(spark, sf):
    return V.customers(spark, sf).agg(F.round(F.avg("churned"), 6).alias("rate"), F.count(F.lit(1)).alias("n"))


@query("row_count", "SELECT count(*) AS n FROM v_ratings_all")
def row_count(spark, sf):
    return V.ratings_all(spark, sf).agg(F.count(F.lit(1)).alias("n"))


@query("label_value_counts", """
SELECT coalesce(a.value, b.value) AS value, coalesce(a.n, 0) AS n_0, coalesce(b.n, 0) AS n_1
FROM (SELECT site_id AS value, count(*) AS n FROM v_impressions WHERE click = 0 GROUP BY 1) a
FULL OUTER JOIN (SELECT site_id AS value, count(*) AS n FROM v_impressions WHERE click = 1 GROUP BY 1) b
  ON a.value = b.value""")
def label_value_counts(spark, sf):
    imp = V.impressions(spark, sf)
    a = imp.filter("click = 0").groupBy(F.col("site_id").alias("value")).agg(F.count(F.lit(1)).alias("n_0"))
    b = imp.filter("click = 1").groupBy(F.col("site_id").alias("value")).agg(F.count(F.lit(1)).alias("n_1"))
    j = a.join(b, "value", "full")
    return j.select("value", F.coalesce("n_0", F.lit(0)).alias("n_0"), F.coalesce("n_1", F.lit(0)).alias("n_1"))


@query("keys_with_min_rows", """
SELECT name, date, price FROM v_prices
WHERE name IN (SELECT name FROM v_prices GROUP BY name HAVING count(*) > 1720)""")
def keys_with_min_rows(spark, sf):
    return R.keys_with_min_rows(V.prices(spark, sf), "name", 1720)
