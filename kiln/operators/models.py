"""Spark ML wrappers: clustering, topics, classification, tuning, ALS,
forecasting (C1-C6, E5, M1-M8, M15, M17, M19, M20, N7-N9, R1-R6).

Fitting is Spark ML's own distributed training; these functions only fix the
inputs (explicit feature lists, stable key-hash splits, seeds) and turn
results into DataFrames. Inputs reused across fits (k sweep, grid, folds)
are persisted once and unpersisted after.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.clustering import LDA, KMeans
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, ClusteringEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.feature import (IDF, CountVectorizer, OneHotEncoder, StringIndexer, VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, LongType

from kiln.operators.prefix import dense_index
from kiln.operators.sampling import hash_split, sample_fraction
from kiln.operators.similarity import knn_neighbours, sq_euclid
from kiln.operators.stats import auc
from kiln.operators.topics import fit_em
from kiln.session import checkpoint_dir, stored

# ---- clustering --------------------------------------------------------------------


def fit_kmeans(df: DataFrame, vec: str, k: int, seed: int = 1, max_iter: int = 20):
    return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=vec, predictionCol="cluster").fit(df)


def kmeans_costs(df: DataFrame, vec_array: str, ks: Sequence[int], key: str, fit_fraction: float = 0.2,
                 seed: int = 1) -> DataFrame:
    """For each k fit on a keyed sample and cost (sum of squared distances
    to the nearest centre) on all rows. The fits run a few at a time; all
    costs come from one aggregate with an expression per k, in one pass."""
    sample = (sample_fraction(df, fit_fraction, key, seed).select(array_to_vector(vec_array).alias("_v"))
              .persist(StorageLevel.MEMORY_AND_DISK))
    with ThreadPool(4) as pool:
        centres = pool.map(lambda k: [c.tolist() for c in fit_kmeans(sample, "_v", k, seed).clusterCenters()], list(ks))
    sample.unpersist()
    near = []
    for k, cs in zip(ks, centres):
        table = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in cs])
        near.append(F.array_min(F.transform(table, lambda c: sq_euclid(F.col(vec_array), c))).alias(f"d{k}"))
    sums = df.select(*near).agg(*[F.round(F.sum(f"d{k}"), 6).alias(f"d{k}") for k in ks])
    return sums.unpivot([], [f"d{k}" for k in ks], "k", "cost").select(
        F.substring("k", 2, 9).cast("int").alias("k"), "cost")


def silhouette(pred: DataFrame, vec: str, cluster: str = "cluster") -> float:
    return ClusteringEvaluator(featuresCol=vec, predictionCol=cluster).evaluate(pred)


# ---- text vectors and topics -------------------------------------------------------------


def count_vectors(df: DataFrame, tokens: str, min_df: float = 2.0, max_df: float | None = None,
                  vocab_size: int | None = None, idf: bool = True):
    """N7 as Spark ML: CountVectorizer (+ IDF with the same minimum). Without
    ``vocab_size`` the vocabulary is as large as the terms are many."""
    cv = CountVectorizer(inputCol=tokens, outputCol="tf_vec", minDF=min_df,
                         vocabSize=vocab_size or distinct_terms(df, tokens))
    if max_df is not None:
        cv.setMaxDF(max_df)
    stages = [cv] + ([IDF(inputCol="tf_vec", outputCol="tfidf_vec", minDocFreq=int(min_df) if min_df >= 1 else 0)]
                     if idf else [])
    model = Pipeline(stages=stages).fit(df)
    return model, model.transform(df)


def distinct_terms(df: DataFrame, tokens: str) -> int:
    """Number of different terms, as a vocabulary size that cuts none."""
    return max(df.select(F.explode(tokens).alias("t")).distinct().count(), 1)


def fit_lda(df: DataFrame, vec: str, k: int, optimizer: str = "online", seed: int = 666, max_iter: int = 20):
    """Spark ML's LDA; with ``em`` the same fit in blocks of documents."""
    if optimizer == "em":
        return fit_em(df, vec, k, seed, max_iter)
    return LDA(k=k, seed=seed, optimizer=optimizer, maxIter=max_iter, featuresCol=vec).fit(df)


def doc_topics(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Topic mixture per document and its best topic (first on ties, null
    for a document without a term)."""
    t = model.transform(df).select(*keep, vector_to_array("topicDistribution").alias("topics"))
    return t.withColumn("topic", F.when(
        F.array_max("topics") > 0, F.array_position("topics", F.array_max("topics")) - 1))


# ---- classification and evaluation ---------------------------------------------------------

FIT_ROWS = 1 << 20  # rows of a partition of the rows that a model is fitted on, at most

KINDS = {
    "logreg": lambda: LogisticRegression(maxIter=50),
    "forest": lambda: RandomForestClassifier(numTrees=50, seed=7),
    "gbt": lambda: GBTClassifier(maxIter=30, seed=7),
    "svc": lambda: LinearSVC(maxIter=50),
}


def classifier(kind: str, **params):
    est = KINDS[kind]()
    return est.setParams(**params) if params else est


def feature_pipeline(numeric: Sequence[str], categorical: Sequence[str] = (), out: str = "features") -> list:
    """E1+E4 as ML stages: index and one-hot the categoricals (unknown
    values kept), assemble with the numerics (rows with NULLs skipped)."""
    stages, cols = [], list(numeric)
    for c in categorical:
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep",
                                 stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCol=f"{c}_idx", outputCol=f"{c}_vec", dropLast=False)]
        cols.append(f"{c}_vec")
    stages.append(VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="skip"))
    return stages


def positive_score(pred: DataFrame, name: str = "score") -> DataFrame:
    """Probability of class 1 when the model has one, else the raw margin."""
    col = "probability" if "probability" in pred.columns else "rawPrediction"
    return pred.withColumn(name, vector_to_array(col).getItem(1))


def fit_predict(kind: str, train: DataFrame, test: DataFrame, stages: list, label: str, **params):
    est = classifier(kind, **params).setLabelCol(label).setFeaturesCol("features")
    model = Pipeline(stages=[*stages, est]).fit(train)
    return model, positive_score(model.transform(test))


def auc_of(pred: DataFrame, label: str, metric: str = "areaUnderROC") -> float:
    col = "probability" if "probability" in pred.columns else "rawPrediction"
    return BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=col, metricName=metric,
                                         numBins=0).evaluate(pred)


def for_fits(df: DataFrame) -> DataFrame:
    """``df`` persisted for fits that pass over it many times. Each pass is a
    task per partition that reports to the driver, and a persisted plan keeps
    all of its shuffle partitions: they are put together to one per core, or
    more if these would hold over ``FIT_ROWS`` rows each."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    df = df.persist()
    parts = max(cores, -(-df.count() // FIT_ROWS))
    if df.rdd.getNumPartitions() <= parts:
        return df
    rows = df.coalesce(parts).persist()
    rows.count()
    df.unpersist()
    return rows


class _DrawnFolds(CrossValidator):
    """Cross validation over folds that the column ``_fold``, uniform in
    [0, 1), was drawn for before."""

    def _kFold(self, dataset: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        n = self.getNumFolds()
        held = [(F.col("_fold") >= i / n) & (F.col("_fold") < (i + 1) / n) for i in range(n)]
        return [(dataset.filter(~h), dataset.filter(h)) for h in held]


def cross_val(df: DataFrame, kind: str, stages: list, label: str, folds: int = 5, grid=None,
              parallelism: int = 2, seed: int = 7):
    """M6/M7: k-fold cross-validated ROC AUC; an empty grid scores the model
    as it is. Returns the fitted CrossValidatorModel."""
    est = classifier(kind).setLabelCol(label).setFeaturesCol("features")
    pipe = Pipeline(stages=[*stages, est])
    grid = grid if grid is not None else ParamGridBuilder().build()
    if grid and isinstance(grid[0], dict) and grid[0]:
        grid = [{est.getParam(p.name): v for p, v in g.items()} for g in grid]
    ev = BinaryClassificationEvaluator(labelCol=label, numBins=0)
    cv = _DrawnFolds(estimator=pipe, estimatorParamMaps=grid, evaluator=ev, numFolds=folds,
                     parallelism=parallelism, seed=seed)
    rows = for_fits(df.withColumn("_fold", F.rand(seed)))
    try:
        return cv.fit(rows)
    finally:
        rows.unpersist()


def knn_fold_scores(df: DataFrame, id_col: str, vec: str, label: str, k: int = 5, folds: int = 5, seed: int = 7) -> DataFrame:
    """M6 for kNN, which has no model to fit: (fold, auc), each fold's rows
    scored by the share of class 1 among their k nearest rows of the other
    folds. Folds come from a hash of the id."""
    rows = stored(hash_split(df.select(id_col, vec, label), id_col, [1] * folds, seed=seed), "knn-folds")
    scores = []
    for f in range(folds):
        near = knn_neighbours(rows.filter(F.col("split") == f), rows.filter(F.col("split") != f), id_col, vec, label, k)
        share = near.groupBy(id_col).agg(F.avg("neighbour_label").alias("score"))
        one = auc(share.join(rows.select(id_col, label), id_col), label, "score")
        scores.append(one.select(F.lit(f).alias("fold"), "auc"))
    return reduce(DataFrame.unionByName, scores)


def vector_names(df: DataFrame, vec: str) -> list[str]:
    """Names of a vector column's entries, from the metadata that the
    assembler left in its schema."""
    groups = df.schema[vec].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted((a for g in groups.values() for a in g), key=lambda a: a["idx"])]


def importance(model, pred: DataFrame, spark, vec: str = "features") -> DataFrame:
    """Feature importances (trees) or coefficients (linear), named from
    the vector metadata of the transformed rows ``pred``."""
    last = model.stages[-1] if hasattr(model, "stages") else model
    vals = last.featureImportances.toArray() if hasattr(last, "featureImportances") else last.coefficients.toArray()
    rows = [(n, float(v)) for n, v in zip(vector_names(pred, vec), vals, strict=True)]
    return spark.createDataFrame(rows, "feature string, value double").orderBy(F.desc(F.abs("value")), "feature")


# ---- recommenders -------------------------------------------------------------------


@dataclass
class NumberedRatings:
    """Ratings with numbers for their ids, and the tables of both, for any
    number of fits."""
    rows: DataFrame
    users: DataFrame
    items: DataFrame


def _numbers(ratings: DataFrame, column: str, name: str) -> DataFrame:
    """(id, number): whole ids that fit an int number themselves, all others
    are numbered from 0."""
    if isinstance(ratings.schema[column].dataType, IntegralType):
        lo, hi = ratings.agg(F.min(column), F.max(column)).first()
        if lo is None or -(1 << 31) <= lo and hi < 1 << 31:
            return ratings.select(column).distinct().withColumn(name, F.col(column).cast("int"))
    return stored(dense_index(ratings, column, name), f"als{name}")


def number_ratings(ratings: DataFrame, user: str = "user_id", item: str = "item_id", rating: str = "rating") -> NumberedRatings:
    """Ids of any size or type as the ints that ALS needs."""
    ratings = stored(ratings.select(user, item, rating).dropna(subset=[user, item]), "als-ratings")
    users, items = _numbers(ratings, user, "_user"), _numbers(ratings, item, "_item")
    rows = ratings
    for table, column, name in ((users, user, "_user"), (items, item, "_item")):
        if isinstance(table.schema[name].dataType, LongType):  # numbered: look the numbers up
            rows = rows.join(table, column).withColumn(name, F.col(name).cast("int"))
        else:
            rows = rows.withColumn(name, F.col(column).cast("int"))
    return NumberedRatings(rows.select("_user", "_item", F.col(rating).cast("float").alias("_rating")), users, items)


def fit_als(ratings: DataFrame | NumberedRatings, rank: int = 12, iters: int = 10, reg: float = 0.2, seed: int = 42,
            user: str = "user_id", item: str = "item_id", rating: str = "rating"):
    """ALS on (user, item, rating), or on ratings numbered before;
    ``IndexedAls`` maps the numbers back. The factor lineage is cut every 10
    iterations in the shared checkpoint folder."""
    numbered = ratings if isinstance(ratings, NumberedRatings) else number_ratings(ratings, user, item, rating)
    checkpoint_dir(numbered.rows.sparkSession)
    als = ALS(rank=rank, maxIter=iters, regParam=reg, seed=seed, userCol="_user", itemCol="_item", ratingCol="_rating",
              coldStartStrategy="nan", checkpointInterval=10)
    return IndexedAls(als.fit(numbered.rows), numbered.users, numbered.items)


@dataclass
class IndexedAls:
    """A fitted ALS model with the tables that map ids to its numbers."""
    model: ALSModel
    users: DataFrame
    items: DataFrame

    def transform(self, pairs: DataFrame, user: str = "user_id", item: str = "item_id") -> DataFrame:
        """``pairs`` with ``prediction``; NaN where user or item is unknown."""
        numbered = pairs.join(self.users, user, "left").join(self.items, item, "left")
        numbered = numbered.withColumns({c: F.coalesce(F.col(c).cast("int"), F.lit(-1)) for c in ("_user", "_item")})
        return self.model.transform(numbered).drop("_user", "_item")

    def save(self, path: str) -> None:
        """The model and its id tables below ``path``, replacing older ones."""
        self.model.write().overwrite().save(f"{path}/model")
        self.users.write.mode("overwrite").parquet(f"{path}/users")
        self.items.write.mode("overwrite").parquet(f"{path}/items")

    @classmethod
    def load(cls, path: str) -> IndexedAls:
        spark = SparkSession.active()
        return cls(ALSModel.load(f"{path}/model"), spark.read.parquet(f"{path}/users"), spark.read.parquet(f"{path}/items"))

    def user_factors(self, user: str = "user_id") -> DataFrame:
        """(user, features) for every user of the training ratings."""
        return self.users.join(self.model.userFactors.withColumnRenamed("id", "_user"), "_user").drop("_user")

    def recommend(self, users: DataFrame, n: int, rated: DataFrame, user: str = "user_id",
                  item: str = "item_id") -> DataFrame:
        """The n best items that each of ``users`` has not rated, by rank.
        Users are asked for in groups of like numbers of ratings (the same
        number of binary digits, so a few dozen groups at most), each with as
        many items more as one of its users has rated."""
        checkpoint_dir(users.sparkSession)
        wanted = users.select(user).distinct()
        counts = rated.join(wanted, user, "left_semi").groupBy(user).agg(F.count(F.lit(1)).alias("_rated"))
        asked = self.users.join(wanted, user).join(counts, user, "left").select(
            F.col("_user").cast("int").alias("_user"), F.coalesce("_rated", F.lit(0)).alias("_rated"))
        asked = asked.withColumn("_digits", F.length(F.bin("_rated"))).checkpoint()
        groups = asked.groupBy("_digits").agg(F.max("_rated").alias("most")).collect() or [(1, 0)]
        recs = reduce(DataFrame.unionByName, [
            self.model.recommendForUserSubset(asked.filter(F.col("_digits") == digits).select("_user"), n + most)
            for digits, most in sorted(groups)])
        recs = recs.select("_user", F.explode("recommendations").alias("r")).select(
            "_user", F.col("r._item").alias("_item"), F.col("r.rating").cast("double").alias("pred"))
        named = recs.join(self.users, "_user").join(self.items, "_item").drop("_user", "_item")
        left = named.join(rated.select(user, item), [user, item], "left_anti")
        best = Window.partitionBy(user).orderBy(F.desc("pred"), item)
        return left.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def predict_pairs(model, pairs: DataFrame, fill: float | None = 3.7, upper: float | None = 5.0,
                  user: str = "user_id", item: str = "item_id") -> DataFrame:
    """Predictions for given pairs; pairs the model cannot score
    (unseen user or item) get ``fill``; the upper clip only, as the reference."""
    p = model.transform(pairs, user, item)
    pred = F.when(F.isnan("prediction"), F.lit(None)).otherwise(F.col("prediction").cast("double"))
    if fill is not None:
        pred = F.coalesce(pred, F.lit(float(fill)))
    if upper is not None:
        pred = F.least(pred, F.lit(float(upper)))
    return p.withColumn("pred", pred).drop("prediction")


def als_grid(train: DataFrame, valid: DataFrame, holdout: DataFrame, settings: Sequence[tuple[int, float, int]],
             seed: int = 42) -> DataFrame:
    """Validation RMSE for every (rank, reg, iterations) and, for the best
    one, the RMSE on ``holdout``; train is numbered and written once for all fits."""
    numbered = number_ratings(train)
    ev = RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="pred")
    rows, best = [], None
    for rank, reg, iters in settings:
        m = fit_als(numbered, rank=rank, iters=iters, reg=reg, seed=seed)
        rows.append((rank, reg, iters, float(ev.evaluate(predict_pairs(m, valid)))))
        if best is None or rows[-1][3] < best[0]:
            best = rows[-1][3], m
    held = float(ev.evaluate(predict_pairs(best[1], holdout)))
    out = [(*r, held if r[3] == best[0] else None) for r in rows]
    return train.sparkSession.createDataFrame(out, "rank int, reg double, iters int, rmse double, holdout_rmse double")


def forecast_linear(windows: DataFrame, train_flag: str = "is_train"):
    """One linear model over all keys from the T previous values to the
    next value (re-aimed from the per-symbol LSTM)."""
    data = windows.withColumn("features", array_to_vector("x"))
    model = LinearRegression(featuresCol="features", labelCol="y", predictionCol="pred") \
        .fit(data.filter(F.col(train_flag)))
    return model, model.transform(data.filter(~F.col(train_flag)))
