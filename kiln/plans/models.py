"""Model-shaped queries (row check only): clustering, topics, PCA,
classifiers, tuning, ALS, forecasting, Word2Vec."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions.words import SPARK_ENGLISH
from kiln.operators import clean as CL
from kiln.operators import features as FE
from kiln.operators import models as M
from kiln.operators import recommend as RC
from kiln.operators import sampling as SM
from kiln.operators import series as SE
from kiln.operators import stats as ST
from kiln.operators import terms as TM
from kiln.operators import text as TX
from kiln.operators import word2vec as W2
from kiln.plans.cleaning import unit_sql
from kiln.plans.registry import query
from kiln.plans.text import COMMENT_TOKENS, ENGLISH_SQL, MAX_DF, MAX_TERMS, MIN_DF, WORD_SPLIT, plot_terms
from kiln.session import stored
from kiln.sources import views as V
from kiln.sources.tables import load

CUST_NUM = ["n_orders", "order_total", "avg_order", "tenure"]
CUST_CAT = ["segment"]


def _customers_split(spark, sf):
    c = V.customers(spark, sf).withColumn("label", F.col("churned").cast("double"))
    s = SM.hash_split(c, "customer_id", [8, 2], seed=11)
    return s.filter("split = 0"), s.filter("split = 1")


def _cust_stages():
    return M.feature_pipeline(CUST_NUM, CUST_CAT)


def _fit(kind, spark, sf, **params):
    train, test = _customers_split(spark, sf)
    _, pred = M.fit_predict(kind, train, test, _cust_stages(), "label", **params)
    return pred.select("customer_id", "label", F.col("prediction").cast("double").alias("prediction"),
                       F.round("score", 6).alias("score"))


@query("fit_logreg")
def fit_logreg(spark, sf):
    """M1: logistic regression on customer features; test-part scores."""
    return _fit("logreg", spark, sf)


@query("fit_forest")
def fit_forest(spark, sf):
    """M2: random forest on customer features; test-part scores."""
    return _fit("forest", spark, sf)


@query("fit_svc")
def fit_svc(spark, sf):
    """M4: linear support vector machine (margin as score)."""
    return _fit("svc", spark, sf)


@query("fit_gbt")
def fit_gbt(spark, sf):
    """M3: gradient-boosted trees on impressions with early stopping on a
    validation flag cut from train by id hash (not the test set)."""
    imp = V.impressions(spark, sf).withColumn("label", F.col("click").cast("double"))
    s = SM.hash_split(imp, "id", [7, 1, 2], seed=3)
    train = s.filter("split < 2").withColumn("is_valid", F.col("split") == 1)
    test = s.filter("split = 2")
    stages = M.feature_pipeline(["c1", "banner_pos", "site_id", "value"], ["site_category"])
    est = M.classifier("gbt", validationIndicatorCol="is_valid", maxIter=20).setLabelCol("label")
    model = Pipeline(stages=[*stages, est]).fit(train)
    pred = M.positive_score(model.transform(test))
    return pred.select("id", "label", "prediction", F.round("score", 6).alias("score"))


@query("compare_models")
def compare_models(spark, sf):
    """Several models on one split, which is kept over the fits;
    one row per model."""
    train, test = (M.for_fits(x) for x in _customers_split(spark, sf))
    rows = []
    for kind in ("logreg", "forest", "gbt", "svc"):
        _, pred = M.fit_predict(kind, train, test, _cust_stages(), "label")
        sc = ST.binary_scores(ST.confusion(pred, "label", "prediction"))
        row = sc.withColumn("model", F.lit(kind)).withColumn("auc", F.lit(round(M.auc_of(pred, "label"), 6)))
        rows.append(spark.createDataFrame(row.collect(), row.schema))  # one row
    train.unpersist()
    test.unpersist()
    return reduce(DataFrame.unionByName, rows)


@query("cv_scores")
def cv_scores(spark, sf):
    """M6: 5-fold cross-validated ROC AUC per model (empty grid), kNN among them."""
    train, _ = _customers_split(spark, sf)
    train = train.persist()
    rows = []
    for kind in ("logreg", "forest", "gbt", "svc"):
        cvm = M.cross_val(train, kind, _cust_stages(), "label", folds=5)
        rows.append((kind, float(cvm.avgMetrics[0])))
    vectors = Pipeline(stages=[*_cust_stages(), StandardScaler(inputCol="features", outputCol="scaled")]).fit(train).transform(train)
    folds = M.knn_fold_scores(vectors.withColumn("v", vector_to_array("scaled")), "customer_id", "v", "label")
    rows.append(("knn", float(folds.agg(F.avg("auc")).first()[0])))
    train.unpersist()
    return spark.createDataFrame(rows, "model string, auc double")


@query("grid_search_trees")
def grid_search_trees(spark, sf):
    """M7 for trees: depth x number of trees by 3-fold AUC, for the random
    forest and for boosting; every grid point, the best of each model flagged."""
    train, _ = _customers_split(spark, sf)
    train = train.persist()
    out = []
    for kind, est, trees in (("forest", RandomForestClassifier(), "numTrees"), ("gbt", GBTClassifier(), "maxIter")):
        grid = [{est.maxDepth: d, est.getParam(trees): n} for d in (3, 5) for n in (10, 20)]
        cvm = M.cross_val(train, kind, _cust_stages(), "label", folds=3, grid=grid)
        rows = [(kind, g[est.maxDepth], g[est.getParam(trees)], float(m)) for g, m in zip(grid, cvm.avgMetrics)]
        best = max(rows, key=lambda r: r[3])
        out += [(*r, r == best) for r in rows]
    train.unpersist()
    return spark.createDataFrame(out, "model string, depth int, trees int, auc double, best boolean")


@query("grid_search")
def grid_search(spark, sf):
    """M7: logistic regression over regParam x elasticNetParam by 5-fold
    AUC; every grid point with its score and the best flagged."""
    from pyspark.ml.classification import LogisticRegression
    train, _ = _customers_split(spark, sf)
    lr = LogisticRegression()
    grid = [{lr.regParam: r, lr.elasticNetParam: e} for r in (0.01, 0.1, 1.0) for e in (0.0, 1.0)]
    train = train.persist()
    cvm = M.cross_val(train, "logreg", _cust_stages(), "label", folds=5, grid=grid)
    train.unpersist()
    rows = [(g[lr.regParam], g[lr.elasticNetParam], float(m)) for g, m in zip(grid, cvm.avgMetrics)]
    best = max(rows, key=lambda r: r[2])
    return spark.createDataFrame([(*r, r == best) for r in rows], "reg double, enet double, auc double, best boolean")


@query("feature_importance")
def feature_importance(spark, sf):
    """Random-forest importances with feature names."""
    train, test = _customers_split(spark, sf)
    model, pred = M.fit_predict("forest", train, test, _cust_stages(), "label")
    return M.importance(model, pred, spark)


# ---- clustering, topics, projections --------------------------------------------------------

@query("kmeans_points")
def kmeans_points(spark, sf):
    """K-means (k = 16) on incident coordinates; every row's cluster."""
    inc = V.incidents(spark, sf).select("incident_id", array_to_vector(F.array("x", "y")).alias("xy"))
    model = M.fit_kmeans(inc, "xy", 16, seed=1)
    return model.transform(inc).select("incident_id", "cluster")


@query("kmeans_elbow")
def kmeans_elbow(spark, sf):
    """Cost for k = 2..20, fitted on a 20 % sample, cost on all points."""
    return M.kmeans_costs(V.points(spark, sf), "features", range(2, 21), "point_id", fit_fraction=0.2, seed=1)


@query("silhouette")
def silhouette(spark, sf):
    """C4: silhouette of a k = 10 clustering of the embeddings."""
    pts = V.points(spark, sf).withColumn("v", array_to_vector("features"))
    pred = M.fit_kmeans(pts, "v", 10, seed=1).transform(pts)
    return spark.createDataFrame([(10, round(float(M.silhouette(pred, "v")), 6))], "k int, silhouette double")


def _plot_stems(spark, sf):
    """Tokens of the plots and the TF-IDF weights of their stems."""
    words = TX.keep_alpha(plot_terms(spark, sf), "tokens")
    return words, TM.stem_tfidf(words, "movie_id", "tokens", MIN_DF, MAX_DF, MAX_TERMS, digits=None)


def _plot_clusters(spark, sf):
    """(weights, every plot's k-means cluster of 5)."""
    words, weights = _plot_stems(spark, sf)
    vec = TM.term_vectors(weights, TM.term_index(weights), "movie_id", docs=words)
    return weights, M.fit_kmeans(vec, "vec", 5, seed=1).transform(vec).select("movie_id", "cluster")


@query("stem_tfidf")
def stem_tfidf(spark, sf):
    """TF-IDF of plot stems, each named by its most frequent word."""
    w = _plot_stems(spark, sf)[1]
    return w.withColumn("weight", F.round("weight", 6))


@query("kmeans_docs")
def kmeans_docs(spark, sf):
    """K-means (k = 5) on the TF-IDF vectors of plot stems."""
    return _plot_clusters(spark, sf)[1]


@query("cluster_words")
def cluster_words(spark, sf):
    """The ten words that weigh most in each k-means cluster, stems by
    their most frequent word."""
    weights, pred = _plot_clusters(spark, sf)
    top = TX.top_terms(weights.join(pred, "movie_id"), "cluster", 10, term="surface")
    return top.select("cluster", F.col("rank").cast("long").alias("rank"), F.col("surface").alias("word"), "weight")


@query("cluster_members")
def cluster_members(spark, sf):
    """Every plot's title with its k-means cluster and that cluster's
    size: a row per title, so a large cluster is never one group."""
    pred = stored(_plot_clusters(spark, sf)[1], "clusters")
    sizes = pred.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    titles = V.movies(spark, sf).select("movie_id", "title")
    return pred.join(titles, "movie_id").join(sizes, "cluster").select("cluster", "n", "movie_id", "title")


@query("lda_em")
def lda_em(spark, sf):
    """EM LDA with 2 topics on comment count-IDF vectors; top 100 terms.
    The fit and its terms are tables: no list of all terms is made."""
    c = TX.drop_stopwords(TX.tokens(V.comments(spark, sf), "comment", WORD_SPLIT), "tokens", SPARK_ENGLISH)
    weights, index = TX.count_idf(c, "comment_id", "tokens", min_doc_freq=2, number=TM.term_index)
    vec = TM.term_vectors(weights, index, "comment_id")
    model = M.fit_lda(vec, "vec", 2, optimizer="em", seed=666, max_iter=10)
    return TM.topic_terms(model, index, 100)


def _plot_topics(spark, sf):
    """(model, vectors, stem weights, term table) of online LDA with 5 topics
    on integer-scaled TF-IDF."""
    words, weights = _plot_stems(spark, sf)
    index = TM.term_index(weights)
    counts = weights.withColumn("weight", F.floor(F.col("weight") * 100)).filter("weight > 0")
    vec = TM.term_vectors(counts, index, "movie_id", docs=words)
    return M.fit_lda(vec, "vec", 5, optimizer="online", seed=666, max_iter=10), vec, weights, index


@query("lda_online")
def lda_online(spark, sf):
    """Online LDA with 5 topics; every plot's topic mixture and best topic."""
    model, vec, _, _ = _plot_topics(spark, sf)
    t = M.doc_topics(model, vec, ["movie_id"])
    return t.select("movie_id", "topic", F.transform("topics", lambda x: F.round(x, 6)).alias("topics"))


@query("topic_words")
def topic_words(spark, sf):
    """The ten heaviest words of each plot topic, stems by their most
    frequent word."""
    model, _, weights, index = _plot_topics(spark, sf)
    names = weights.select("term", "surface").distinct()
    return TM.topic_terms(model, index, 10).join(names, "term").select(
        "topic", "rank", F.col("surface").alias("word"), F.round("weight", 6).alias("weight"))


@query("pca_terms")
def pca_terms(spark, sf):
    """E5: first two principal components of the plots' sparse TF-IDF vectors."""
    words, weights = _plot_stems(spark, sf)
    vec = TM.term_vectors(weights, TM.term_index(weights), "movie_id", docs=words)
    _, proj = FE.pca_sparse(vec, "vec", k=2)
    return proj.select("movie_id", *[F.round(F.col("pca")[i], 6).alias(f"pc{i + 1}") for i in range(2)])


@query("pca_topics")
def pca_topics(spark, sf):
    """E5: first two principal components of the plots' topic mixtures."""
    model, vec, _, _ = _plot_topics(spark, sf)
    t = M.doc_topics(model, vec, ["movie_id"]).select("movie_id", array_to_vector("topics").alias("mixture"))
    _, proj = FE.pca(t, "mixture", k=2)
    a = vector_to_array("pca")
    return proj.select("movie_id", F.round(a[0], 6).alias("pc1"), F.round(a[1], 6).alias("pc2"))


@query("assemble_features", """
SELECT customer_id, [CAST(n_orders AS DOUBLE), order_total, floor(avg_order), CAST(tenure AS DOUBLE)] AS features
FROM v_customers WHERE n_orders IS NOT NULL AND order_total IS NOT NULL AND avg_order IS NOT NULL AND tenure IS NOT NULL""")
def assemble_features(spark, sf):
    """The numeric customer columns as one vector; rows with a missing value go."""
    v = FE.assemble(V.customers(spark, sf).withColumn("avg_order", F.floor("avg_order")), CUST_NUM)
    return v.select("customer_id", vector_to_array("features").alias("features"))


@query("pca_project")
def pca_project(spark, sf):
    """E5: first two principal components of the embeddings."""
    pts = V.points(spark, sf).withColumn("v", array_to_vector("features"))
    _, proj = FE.pca(pts, "v", k=2)
    a = vector_to_array("pca")
    return proj.select("point_id", F.round(a[0], 6).alias("pc1"), F.round(a[1], 6).alias("pc2"))


# ---- text models ------------------------------------------------------------------

@query("word2vec_docs")
def word2vec_docs(spark, sf):
    """100-dimensional Word2Vec document vectors of the comments."""
    c = TX.drop_stopwords(TX.tokens(V.comments(spark, sf), "comment", WORD_SPLIT), "tokens", SPARK_ENGLISH)
    _, out = W2.word2vec(c.select("comment_id", "tokens"), "tokens", dims=100, min_count=1)
    return out.select("comment_id", vector_to_array("w2v").alias("vector"))


@query("score_all")
def score_all(spark, sf):
    """Train on rule-labelled comments (F7), score every comment,
    labelled or not (Q22), with Word2Vec features."""
    from kiln.plans.cleaning import LABEL_NEGATIVE, LABEL_POSITIVE
    c = CL.rule_label(V.comments(spark, sf), "comment", LABEL_POSITIVE, LABEL_NEGATIVE)
    c = TX.drop_stopwords(TX.tokens(c, "comment", WORD_SPLIT), "tokens", SPARK_ENGLISH)
    _, vec = W2.word2vec(c.select("comment_id", "label", "tokens"), "tokens", dims=50, min_count=1)
    train = vec.filter(F.col("label").isNotNull()).withColumn("label", F.col("label").cast("double"))
    lr = M.classifier("logreg").setFeaturesCol("w2v").setLabelCol("label")
    pred = lr.fit(train).transform(vec.drop("label"))
    return pred.select("comment_id", F.col("prediction").cast("int").alias("prediction"))


@query("text_pipeline", f"""
WITH tok AS (SELECT comment_id, unnest(list_filter({COMMENT_TOKENS}, lambda x: NOT list_contains({ENGLISH_SQL}, x))) AS term FROM v_comments),
st AS (SELECT term FROM tok WHERE {unit_sql('comment_id', 5)} < CAST(0.8 AS DOUBLE)
       GROUP BY term HAVING count(DISTINCT comment_id) >= 2),
n AS (SELECT comment_id, count(*) AS n FROM tok JOIN st USING (term) GROUP BY comment_id)
SELECT c.comment_id, CAST((SELECT count(*) FROM st) AS INTEGER) AS vocab, CAST(coalesce(n.n, 0) AS DOUBLE) AS n_terms
FROM v_comments c LEFT JOIN n ON n.comment_id = c.comment_id""")
def text_pipeline(spark, sf):
    """Split -> stop words -> counts, fitted once on the train part and
    applied to all comments; the vocabulary is a table."""
    com = V.comments(spark, sf)
    train = SM.hash_split(com, "comment_id", [8, 2], seed=5).filter("split = 0")
    fitted = TM.TermPipeline.fit(train, "comment_id", "comment", SPARK_ENGLISH, WORD_SPLIT)
    v = F.unwrap_udt(F.col("tf_vec"))
    return fitted.transform(com, "comment_id", "comment").select(
        "comment_id", v["size"].alias("vocab"),
        F.aggregate(v["values"], F.lit(0.0), lambda a, x: a + x).alias("n_terms"))


# ---- forecasting ------------------------------------------------------------------

@query("forecast_next")
def forecast_next(spark, sf):
    """Next price from the previous T = 3, 5, 7, 10, a linear model over
    all series for each T, fitted on the first 80 % of each series' windows;
    APE on the rest."""
    prices = V.prices(spark, sf)
    n = prices.groupBy("name").agg(F.count(F.lit(1)).alias("_n"))
    parts = []
    for t in (3, 5, 7, 10):
        w = SE.lag_windows(prices, "name", "date", "price", t).join(n, "name")
        flagged = w.withColumn("is_train", F.col("pos") - t <= F.floor((F.col("_n") - t) * 0.8))
        _, pred = M.forecast_linear(flagged)
        parts.append(SE.ape(pred, "y", "pred").select(F.lit(t).alias("t"), "name", "date", "y", F.round("pred", 6).alias("pred"),
                                                      F.round("ape", 6).alias("ape")))
    return reduce(DataFrame.unionByName, parts)


# ---- ALS ------------------------------------------------------------------------------

ALS_RANK, ALS_REG, ALS_ITERS = 12, 0.2, 10


@query("als_fit")
def als_fit(spark, sf):
    """ALS (rank 12, lambda 0.2, 10 iterations); the user factors."""
    model = M.fit_als(V.ratings_train(spark, sf), ALS_RANK, ALS_ITERS, ALS_REG)
    return model.user_factors().select("user_id", F.size("features").alias("rank"))


@query("als_predict")
def als_predict(spark, sf):
    """ALS predictions of every test pair, 3.7 for pairs the model
    cannot score, clipped at 5."""
    model = M.fit_als(V.ratings_train(spark, sf), ALS_RANK, ALS_ITERS, ALS_REG)
    p = M.predict_pairs(model, V.ratings_test(spark, sf))
    return p.select("user_id", "item_id", "rating", F.round("pred", 6).alias("pred"))


@query("als_grid")
def als_grid(spark, sf):
    """Validation RMSE over rank x lambda and rank x iterations on a
    key-hash split (6, 2, 2) of train, and the holdout RMSE of the best."""
    r = V.ratings_train(spark, sf).withColumn("pair", F.concat_ws(":", "user_id", "item_id"))
    s = SM.hash_split(r, "pair", [6, 2, 2], seed=9)
    train, valid, holdout = (s.filter(F.col("split") == i).drop("pair", "split") for i in range(3))
    settings = [(k, reg, ALS_ITERS) for k in (4, 8, 12) for reg in (0.1, 0.2)] + [(k, 0.2, 5) for k in (4, 8, 12)]
    return M.als_grid(train, valid, holdout, settings)


@query("als_refit")
def als_refit(spark, sf):
    """A new user's ten ratings are appended, the model is fitted anew
    and scores the new user's unrated items."""
    train = V.ratings_train(spark, sf).select("user_id", "item_id", "rating")
    new_user = -1
    items = train.select("item_id").distinct()
    first = SM.sample_n(items, 10, "item_id", seed=4)
    new = first.select(F.lit(new_user).cast(train.schema["user_id"].dataType).alias("user_id"), "item_id",
                       (1 + F.col("item_id") % 5).cast("double").alias("rating"))
    every = train.unionByName(new)
    model = M.fit_als(every, ALS_RANK, ALS_ITERS, ALS_REG)
    cand = RC.unrated_items(every, new_user)
    return M.predict_pairs(model, cand, fill=None).select("user_id", "item_id", F.round("pred", 6).alias("pred"))


@query("recommend_many_users")
def recommend_many_users(spark, sf):
    """R5 for many users: the ten best unrated items of every user of train."""
    train = V.ratings_train(spark, sf)
    model = M.fit_als(train, ALS_RANK, ALS_ITERS, ALS_REG)
    r = model.recommend(train.select("user_id"), 10, train)
    return r.select("user_id", "item_id", F.round("pred", 6).alias("pred"), "rank")


@query("recommend_top_n")
def recommend_top_n(spark, sf):
    """The most active user's 10 best unrated items by ALS prediction
    among items with > 50 ratings, with titles."""
    from kiln.plans.neighbours import MIN_COUNT, _top_user
    train = V.ratings_train(spark, sf)
    model = M.fit_als(train, ALS_RANK, ALS_ITERS, ALS_REG)
    cand = RC.unrated_items(train, _top_user(train))
    st = train.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_ratings"))
    p = M.predict_pairs(model, cand.join(st.filter(F.col("n_ratings") > MIN_COUNT), "item_id"), fill=None)
    top = p.filter(F.col("pred").isNotNull()).orderBy(F.desc("pred"), "item_id").limit(10)
    titles = load(spark, sf, "part").select(F.col("p_partkey").cast("int").alias("item_id"),
                                            F.col("p_name").alias("title"))
    return top.join(titles, "item_id").select("user_id", "item_id", "title", F.round("pred", 6).alias("pred"),
                                              "n_ratings")
