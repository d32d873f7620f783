"""Cleaning, selection, set, scalar-function and feature queries
(F, K5-K11, X, E, S7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import columns as C
from kiln.operators import clean as CL
from kiln.operators import features as FE
from kiln.operators import sampling as SM
from kiln.operators.prefix import dense_index
from kiln.operators.report import rating_stats, top_n
from kiln.plans.registry import query
from kiln.sources import views as V
from kiln.sources.tables import load

# Fixed rule patterns and parameters (FIXTURES.md section 3).
LABEL_POSITIVE = r"\bthe \w+ on\b"
LABEL_NEGATIVE = r"\bde\b|\bthe\b"
CONFLICT_POSITIVE = r"\bthe\b"
CONFLICT_NEGATIVE = r"\bon\b|\bde\b"
TENURE_EDGES = [12, 24, 36, 48, 60]
TENURE_NAMES = ["Tenure_0-12", "Tenure_12-24", "Tenure_24-36", "Tenure_36-48", "Tenure_48-60", "Tenure_>_60"]
COLD_FILL = 3.7
RATING_CAP = 5.0
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
Z_COLS = ["n_orders", "order_total", "avg_order", "tenure"]
KIND_COLS = ["segment", "nation", "n_orders", "tenure", "churned"]


@query("project_rename", "SELECT comment_id AS id, creator_name AS creator, userid AS user_id FROM v_comments")
def project_rename(spark, sf):
    return CL.select_rename(V.comments(spark, sf), {"comment_id": "id", "creator_name": "creator", "userid": "user_id"})


@query("drop_nulls", "SELECT movie_id, genre FROM v_movies WHERE genre IS NOT NULL")
def drop_nulls(spark, sf):
    return CL.drop_missing(V.movies(spark, sf).select("movie_id", "genre"), ["genre"])


@query("dedupe_rows", "SELECT DISTINCT text, lang, source FROM documents")
def dedupe_rows(spark, sf):
    return CL.drop_repeats(load(spark, sf, "documents").select("text", "lang", "source"))


@query("filter_between", """
SELECT incident_id, category, x FROM v_incidents
WHERE category = 'click' AND x BETWEEN CAST(-122.45 AS DOUBLE) AND CAST(-122.4 AS DOUBLE)""")
def filter_between(spark, sf):
    inc = V.incidents(spark, sf)
    return CL.select_where(inc, F.col("category") == "click", F.col("x").between(-122.45, -122.4)) \
        .select("incident_id", "category", "x")


@query("filter_movies", """
SELECT movie_id, title, year FROM v_movies
WHERE length(plot) >= 2000 AND origin = 'src1' AND year > 1990""")
def filter_movies(spark, sf):
    m = V.movies(spark, sf)
    return CL.select_where(m, F.length("plot") >= 2000, F.col("origin") == "src1", F.col("year") > 1990) \
        .select("movie_id", "title", "year")


@query("set_intersect", """
SELECT movie_id FROM v_movies WHERE length(plot) >= 2000
INTERSECT SELECT movie_id FROM v_movies WHERE origin = 'src1'
INTERSECT SELECT movie_id FROM v_movies WHERE year > 1990""")
def set_intersect(spark, sf):
    m = V.movies(spark, sf)
    a = m.filter(F.length("plot") >= 2000).select("movie_id")
    b = m.filter(F.col("origin") == "src1").select("movie_id")
    c = m.filter(F.col("year") > 1990).select("movie_id")
    return CL.common(CL.common(a, b), c)


@query("rule_label", f"""
SELECT comment_id,
       CASE WHEN regexp_matches(comment, '{LABEL_POSITIVE}') THEN 1
            WHEN NOT regexp_matches(comment, '{LABEL_NEGATIVE}') THEN 0 END AS label
FROM v_comments""")
def rule_label(spark, sf):
    return CL.rule_label(V.comments(spark, sf), "comment", LABEL_POSITIVE, LABEL_NEGATIVE) \
        .select("comment_id", "label")


@query("rule_conflicts", f"""
SELECT CAST(count_if(regexp_matches(comment, '{CONFLICT_POSITIVE}')
                AND regexp_matches(comment, '{CONFLICT_NEGATIVE}')) AS BIGINT) AS n
FROM v_comments""")
def rule_conflicts(spark, sf):
    return CL.rule_conflicts(V.comments(spark, sf), "comment", CONFLICT_POSITIVE, CONFLICT_NEGATIVE)


@query("trim_text", "SELECT trim(resolution) AS resolution, count(*) AS n FROM v_incidents GROUP BY 1")
def trim_text(spark, sf):
    t = CL.clean_text(V.incidents(spark, sf).select("resolution"), ["resolution"])
    return t.groupBy("resolution").agg(F.count(F.lit(1)).alias("n"))


@query("recode_map", """
SELECT customer_id, CASE trim(churn_text) WHEN 'True.' THEN 1 WHEN 'False.' THEN 0 END AS churn_flag
FROM v_customers""")
def recode_map(spark, sf):
    c = V.customers(spark, sf).select("customer_id", "churn_text")
    return CL.recode(c, "churn_text", {"True.": 1, "False.": 0}, name="churn_flag").drop("churn_text")


@query("genre_clean", "SELECT movie_id, translate(genre, '/', ',') AS genre FROM v_movies")
def genre_clean(spark, sf):
    return CL.replace_chars(V.movies(spark, sf).select("movie_id", "genre"), "genre", "/", ",")


@query("blank_to_null", """
SELECT count(*) AS n, CAST(count_if(x IS NULL) AS BIGINT) AS n_dropped,
       round(CAST(CAST(count_if(x IS NULL) AS BIGINT) AS DOUBLE) * 100 / count(*), 6) AS dropped_pct,
       round(sum(x), 2) AS total
FROM (SELECT TRY_CAST(nullif(trim(total_charge), '') AS DOUBLE) AS x FROM v_customers)""")
def blank_to_null(spark, sf):
    c = CL.blank_to_number(V.customers(spark, sf), "total_charge", "x")
    rep = CL.dropped_share(c, "x")
    return rep.withColumn("total", c.agg(F.round(F.sum("x"), 2)).scalar())


@query("parse_number", r"""
SELECT event_id, TRY_CAST(nullif(trim(regexp_extract(props, ':\s*([0-9.]+)', 1)), '') AS DOUBLE) AS k
FROM events""")
def parse_number(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select("event_id", C.to_number(F.regexp_extract("props", r":\s*([0-9.]+)", 1)).alias("k"))


@query("tenure_group", "SELECT CASE " + " ".join(
    f"WHEN tenure <= {e} THEN '{n}'" for e, n in zip(TENURE_EDGES, TENURE_NAMES))
    + f" ELSE '{TENURE_NAMES[-1]}' END AS tenure_group, count(*) AS n FROM v_customers GROUP BY 1")
def tenure_group(spark, sf):
    c = CL.bin_recode(V.customers(spark, sf), "tenure", TENURE_EDGES, TENURE_NAMES, "tenure_group")
    return c.groupBy("tenure_group").agg(F.count(F.lit(1)).alias("n"))


@query("dense_row_id", "SELECT movie_id, row_number() OVER (ORDER BY movie_id) - 1 AS row_id FROM v_movies")
def dense_row_id(spark, sf):
    return dense_index(V.movies(spark, sf), "movie_id", "row_id")


@query("index_ids", """
SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS user_idx
FROM (SELECT DISTINCT user_id FROM v_ratings_all)""")
def index_ids(spark, sf):
    return dense_index(V.ratings_all(spark, sf), "user_id", "user_idx")


@query("cold_start_pairs", """
SELECT t.user_id, t.item_id,
       t.user_id IN (SELECT user_id FROM v_ratings_train) AS user_known,
       t.item_id IN (SELECT item_id FROM v_ratings_train) AS item_known
FROM v_ratings_test t""")
def cold_start_pairs(spark, sf):
    test = V.ratings_test(spark, sf).select("user_id", "item_id")
    return CL.flag_known(test, V.ratings_train(spark, sf))


@query("recent_docs", "SELECT movie_id, year, title FROM v_movies ORDER BY year DESC, movie_id LIMIT 100")
def recent_docs(spark, sf):
    return top_n(V.movies(spark, sf).select("movie_id", "year", "title"), [F.desc("year"), "movie_id"], 100)


@query("append_ratings", """
WITH u AS (SELECT user_id, item_id, rating, 0 AS v FROM v_ratings_train
           UNION ALL
           SELECT user_id, item_id, rating, 1 AS v FROM v_ratings_test WHERE user_id % 13 = 0),
     m AS (SELECT user_id, item_id, arg_max(rating, v) AS rating FROM u GROUP BY user_id, item_id)
SELECT item_id, count(*) AS n, round(sum(rating), 6) AS total, round(avg(rating), 6) AS mean
FROM m GROUP BY item_id""")
def append_ratings(spark, sf):
    train = V.ratings_train(spark, sf)
    new_user_rows = V.ratings_test(spark, sf).filter(F.col("user_id") % V.COLD_USER_MOD == 0)
    merged = CL.append_latest(train, new_user_rows, ["user_id", "item_id"])
    return rating_stats(merged, "item_id")


@query("impute_cold", """
SELECT t.user_id, t.item_id, round(least(coalesce(s.mean, CAST(3.7 AS DOUBLE)), CAST(5.0 AS DOUBLE)), 6) AS pred
FROM v_ratings_test t
LEFT JOIN (SELECT item_id, avg(rating) AS mean FROM v_ratings_train GROUP BY item_id) s
  ON t.item_id = s.item_id""")
def impute_cold(spark, sf):
    test = V.ratings_test(spark, sf).select("user_id", "item_id")
    means = V.ratings_train(spark, sf).groupBy("item_id").agg(F.avg("rating").alias("pred"))
    p = CL.fill_missing(test.join(means, "item_id", "left"), "pred", COLD_FILL)
    return CL.clip_upper(p, "pred", RATING_CAP).withColumn("pred", F.round("pred", 6))


@query("string_features", r"""
SELECT comment_id,
       CAST(length(comment) AS BIGINT) AS n_chars,
       (length(comment) - length(replace(comment, 'the', ''))) / 3 AS n_the,
       CAST(length(comment) - length(replace(comment, chr(10), '')) + 1 AS BIGINT) AS n_lines,
       regexp_matches(comment, '[0-9]') AS has_digit,
       contains(comment, ' de ') AS has_de,
       comment LIKE 'a%' AS starts_a,
       CAST(len(string_split(trim(comment), ' ')) AS BIGINT) AS n_words
FROM v_comments""")
def string_features(spark, sf):
    c = F.col("comment")
    return V.comments(spark, sf).select(
        "comment_id",
        F.length(c).cast("long").alias("n_chars"),
        ((F.length(c) - F.length(F.replace(c, F.lit("the"), F.lit("")))) / 3).alias("n_the"),
        (F.length(c) - F.length(F.regexp_replace(c, "\n", "")) + 1).cast("long").alias("n_lines"),
        c.rlike("[0-9]").alias("has_digit"),
        c.contains(" de ").alias("has_de"),
        c.like("a%").alias("starts_a"),
        F.size(F.split(F.trim(c), " ")).cast("long").alias("n_words"),
    )


@query("date_features", """
SELECT event_id, CAST(ts AS DATE) AS date, CAST(hour(ts) AS BIGINT) AS hour, CAST(month(ts) AS BIGINT) AS month,
       dayname(ts) AS weekday, dayname(ts) IN ('Saturday', 'Sunday') AS is_weekend
FROM events""")
def date_features(spark, sf):
    return FE.time_features(load(spark, sf, "events"), "ts", keep=["event_id"])


@query("hour_stamp_parse", """
SELECT CAST(hour(strptime(hour_code, '%y%m%d%H')) AS BIGINT) AS hour,
       CAST(strptime(hour_code, '%y%m%d%H') AS DATE) AS date, count(*) AS n
FROM v_impressions GROUP BY 1, 2""")
def hour_stamp_parse(spark, sf):
    imp = V.impressions(spark, sf)
    t = F.try_to_timestamp("hour_code", F.lit("yyMMddHH"))
    return imp.groupBy(F.hour(t).cast("long").alias("hour"), t.cast("date").alias("date")) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("array_features", """
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS n,
       round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS norm,
       round(list_sum(list_transform(embedding[1:3], lambda x: CAST(x AS DOUBLE))), 6) AS head3
FROM embeddings""")
def array_features(spark, sf):
    e = load(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    head = F.aggregate(F.slice("v", 1, 3), F.lit(0.0), lambda a, x: a + x)
    return e.select("vec_id", F.size("v").cast("long").alias("n"), F.round(C.norm2("v"), 6).alias("norm"),
                    F.round(head, 6).alias("head3"))


@query("argmax_row", """
SELECT point_id, CAST(list_position(features, list_max(features)) AS BIGINT) AS best FROM v_points""")
def argmax_row(spark, sf):
    return V.points(spark, sf).select("point_id", C.argmax("features").cast("long").alias("best"))


@query("one_hot_wide", "SELECT customer_id, " + ", ".join(
    f"CAST(segment = '{s}' AS INTEGER) AS segment_{s}" for s in SEGMENTS) + " FROM v_customers")
def one_hot_wide(spark, sf):
    return FE.one_hot(V.customers(spark, sf), "segment", keep=["customer_id"])


@query("standardise", "SELECT customer_id, " + ", ".join(
    f"round((v.{c} - s.m_{c}) / nullif(s.s_{c}, 0), 6) AS z_{c}" for c in Z_COLS)
    + " FROM v_customers v, (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in Z_COLS) + " FROM v_customers) s")
def standardise(spark, sf):
    c = V.customers(spark, sf)
    return FE.standardise(c, c, Z_COLS, keep=["customer_id"])


@query("categorical_columns", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct, "
    f"CASE WHEN count(DISTINCT {c}) < 7 THEN 'categorical' ELSE 'numeric' END AS kind FROM v_customers"
    for c in KIND_COLS))
def categorical_columns(spark, sf):
    return FE.split_columns(V.customers(spark, sf), KIND_COLS)


# ---- model- or sample-shaped outputs: row check only --------------------------

def _hash_sql(key: str, seed: int) -> str:
    """``sampling.key_hash`` in SQL."""
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 15) AS BIGINT)"


def unit_sql(key: str, seed: int) -> str:
    return f"(CAST({_hash_sql(key, seed)} AS DOUBLE) / CAST({1 << 60} AS DOUBLE))"


@query("sample_hash_n", f"SELECT * FROM v_impressions ORDER BY {_hash_sql('id', 7)}, id LIMIT 1000")
def sample_hash_n(spark, sf):
    """Exactly 1,000 impressions chosen by key hash."""
    return SM.sample_n(V.impressions(spark, sf), 1000, key="id", seed=7)


@query("rebalance", f"""
SELECT click, count(*) AS n FROM v_impressions
WHERE click = 1 OR (click = 0 AND {unit_sql('id', 42)} < CAST(0.015 AS DOUBLE)) GROUP BY click""")
def rebalance(spark, sf):
    """K9: every click row and 1.5 % of the others, stable by id hash."""
    s = SM.class_sample(V.impressions(spark, sf), "click", {1: 1.0, 0: 0.015}, key="id")
    return s.groupBy("click").agg(F.count(F.lit(1)).alias("n"))


@query("hash_split_counts", f"""
WITH u AS (SELECT {unit_sql("(CAST(user_id AS VARCHAR) || ':' || CAST(item_id AS VARCHAR))", 42)} AS u FROM v_ratings_all)
SELECT CASE WHEN u < CAST({6 / 10} AS DOUBLE) THEN 0 WHEN u < CAST({6 / 10 + 2 / 10} AS DOUBLE) THEN 1 ELSE 2 END AS split,
       count(*) AS n FROM u GROUP BY 1""")
def hash_split_counts(spark, sf):
    """6/2/2 split of all ratings by (user, item) hash; rows per split."""
    r = V.ratings_all(spark, sf).withColumn("pair", F.concat_ws(":", "user_id", "item_id"))
    return SM.hash_split(r, "pair", [6, 2, 2]).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("hash_features", """
SELECT id, CAST('0x' || substr(md5(CAST(site_category AS VARCHAR)), 1, 15) AS BIGINT) % 1000 AS site_category_code,
       CAST('0x' || substr(md5(CAST(device_id AS VARCHAR)), 1, 15) AS BIGINT) % 1000 AS device_id_code
FROM v_impressions""")
def hash_features(spark, sf):
    """Categorical impression fields as stable codes in [0, 1000)."""
    return FE.hash_features(V.impressions(spark, sf), ["site_category", "device_id"], 1000, keep=["id"])


@query("owner_flags", """
SELECT doc_id, CAST(greatest(coalesce(label, 0), coalesce(prediction, 0)) > 0 AS INTEGER) AS owner
FROM v_scored""")
def owner_flags(spark, sf):
    """F16: positive when the label or the prediction is positive."""
    return CL.either_positive(V.scored(spark, sf), "label", "prediction").select("doc_id", "owner")


@query("preview_rows", """
SELECT incident_id, category, district FROM v_incidents ORDER BY incident_id LIMIT 5""")
def preview_rows(spark, sf):
    """The first rows of a table in a stated order (a top-n, not a
    full sort)."""
    return top_n(V.incidents(spark, sf).select("incident_id", "category", "district"), ["incident_id"], 5)
