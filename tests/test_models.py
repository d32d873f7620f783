"""Planted-answer tests for model-shaped operators (row checks in the
driver): answers the data is built to contain."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kiln.operators import models as M
from kiln.operators import stats as ST
from kiln.operators import terms as TM
from kiln.operators import text as TX


def test_separable_classes_give_high_auc(spark):
    rnd = random.Random(0)
    rows = [(i, float(rnd.gauss(3 * (i % 2), 0.5)), float(rnd.gauss(0, 1)), i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label int") \
        .withColumn("label", F.col("label").cast("double"))
    train, test = df.filter("id % 5 <> 0"), df.filter("id % 5 = 0")
    for kind in ("logreg", "forest", "gbt", "svc"):
        _, pred = M.fit_predict(kind, train, test, M.feature_pipeline(["a", "b"]), "label")
        assert M.auc_of(pred, "label") > 0.95, kind
        assert ST.auc(pred, "label", "score").first()["auc"] > 0.95, kind


def test_kmeans_finds_far_blobs_and_cost_falls(spark):
    rnd = random.Random(1)
    centres = [(0, 0), (50, 50), (-50, 60)]
    rows = [([cx + rnd.gauss(0, 1), cy + rnd.gauss(0, 1)],) for cx, cy in centres for _ in range(60)]
    df = spark.createDataFrame(rows, "p array<double>").withColumn("v", array_to_vector("p"))
    model = M.fit_kmeans(df, "v", 3, seed=3)
    got = sorted((round(c[0]), round(c[1])) for c in model.clusterCenters())
    assert all(min(abs(g[0] - cx) + abs(g[1] - cy) for cx, cy in centres) < 3 for g in got)
    costs = {r["k"]: r["cost"] for r in M.kmeans_costs(df.withColumn("id", F.monotonically_increasing_id()).select("id", "p"), "p", [2, 3, 4], "id", fit_fraction=1.0).collect()}
    assert costs[2] > costs[3] >= costs[4] * 0.999


def test_als_beats_global_mean_on_rank2_table(spark):
    rnd = random.Random(2)
    u = {i: (rnd.uniform(0.5, 1.5), rnd.uniform(0.5, 1.5)) for i in range(60)}
    v = {j: (rnd.uniform(0.5, 1.5), rnd.uniform(0.5, 1.5)) for j in range(40)}
    rows = [(i, j, u[i][0] * v[j][0] + u[i][1] * v[j][1]) for i in u for j in v if rnd.random() < 0.5]
    df = spark.createDataFrame(rows, "user_id long, item_id int, rating double")
    train, test = df.filter("(user_id * 7 + item_id) % 5 <> 0"), df.filter("(user_id * 7 + item_id) % 5 = 0")
    model = M.fit_als(train, rank=2, iters=15, reg=0.01)
    pred = M.predict_pairs(model, test, fill=None, upper=None).filter(F.col("pred").isNotNull())
    als_rmse = ST.rmse(pred, "rating", "pred").first()["rmse"]
    mean = train.agg(F.avg("rating")).first()[0]
    base = ST.rmse(test.withColumn("m", F.lit(mean)), "rating", "m").first()["rmse"]
    assert als_rmse < 0.5 * base


def test_lda_splits_disjoint_vocabularies(spark):
    a = ["apple", "pear", "plum", "fig", "kiwi"]
    b = ["iron", "zinc", "lead", "tin", "gold"]
    rnd = random.Random(4)
    rows = [(i, [rnd.choice(a if i % 2 else b) for _ in range(30)]) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    tf = TX.term_freq(df, "id", "tokens", materialise=True)
    index = TM.term_index(tf)
    vec = TM.term_vectors(tf, index, "id", "tf")
    model = M.fit_lda(vec, "vec", 2, optimizer="em", seed=5, max_iter=30)
    terms = TM.topic_terms(model, index, 5).collect()
    groups = [{r["term"] for r in terms if r["topic"] == t} for t in (0, 1)]
    assert sorted(map(frozenset, groups), key=sorted) == sorted([frozenset(a), frozenset(b)], key=sorted)


def test_pearson_p_values(spark):
    """Against closed forms of the t distribution: one and two degrees of
    freedom, and values of a printed table (r = 0.632 at n = 10, 0.361 at n = 30: p = 0.05)."""
    import math

    import pandas as pd

    p = ST._t_two_sided_p(pd.Series([0.5, -0.9, 0.3, 0.0]), pd.Series([3, 3, 3, 3]))
    t = [r / math.sqrt(1 - r * r) for r in (0.5, 0.9, 0.3, 0.0)]
    assert p.tolist() == pytest.approx([1 - 2 / math.pi * math.atan(x) for x in t], abs=1e-9)
    p = ST._t_two_sided_p(pd.Series([0.5, 0.2]), pd.Series([4, 4]))
    t = [r * math.sqrt(2 / (1 - r * r)) for r in (0.5, 0.2)]
    assert p.tolist() == pytest.approx([1 - x / math.sqrt(2 + x * x) for x in t], abs=1e-9)
    p = ST._t_two_sided_p(pd.Series([0.6319, 0.3610, 1.0, None]), pd.Series([10, 30, 9, 9]))
    assert p[0] == pytest.approx(0.05, abs=2e-4) and p[1] == pytest.approx(0.05, abs=2e-4)
    assert p[2] == 0.0 and math.isnan(p[3])
    rows = [(1.0, 2.0), (2.0, 1.0), (3.0, 4.0), (4.0, 3.0)]
    got = ST.pearson_p(spark.createDataFrame(rows, "a double, y double"), ["a"], "y").first()
    assert (got.r, got.n, got.t, got.p) == (0.6, 4, 1.0607, 0.4)


def test_regression_per_key_equals_numpy(spark):
    import numpy as np

    from kiln.operators import regress as RG
    rng = np.random.default_rng(4)
    rows = []
    for k, n in (("a", 400), ("b", 30), ("c", 2)):
        x = rng.normal(size=(n, 4)) * [1, 10, 0.1, 5] + [1e5, 3, 0, -7]
        y = x @ [0.5, -1, 20, 0.3] + rng.normal(size=n)
        rows += [(k, v.tolist(), float(w)) for v, w in zip(x, y)]
    rows += [("d", [1.0, 2.0, 3.0 * i, 6.0 * i], 2.0 * i) for i in range(9)]  # constant and dependent values
    rows += [("a", None, 1.0), ("a", [1.0, None, 0.0, 0.0], 1.0), ("e", None, 1.0)]
    df = spark.createDataFrame(rows, "k string, x array<double>, y double")
    models = {r.k: r for r in RG.fit_by_key(df, "k", "x", "y", 4).collect()}
    assert set(models) == {"a", "b", "c", "d"}
    for k in ("a", "b"):
        x = np.array([v for kk, v, _ in rows if kk == k and v and None not in v])
        y = np.array([w for kk, v, w in rows if kk == k and v and None not in v])
        full = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x - x.mean(axis=0)]), y, rcond=None)[0]
        assert models[k].coef == pytest.approx(full[1:], rel=1e-6, abs=1e-8) and models[k].n == len(x)
    pred = RG.predict_by_key(df, RG.fit_by_key(df, "k", "x", "y", 4), "k", "x").filter("k in ('c', 'd')").collect()
    assert all(r.pred == pytest.approx(r.y, abs=1e-6) for r in pred)


def test_merged_sketches_count_within_their_error(spark):
    from kiln.operators import report as R
    days = spark.range(60_000).select((F.col("id") % 10).alias("day"), (F.col("id") % 25_000).alias("u"))
    stored = R.distinct_sketches(days, ["day"], "u")
    whole = R.sketch_counts(R.merge_sketches(stored, []), "n").first().n
    assert abs(whole - 25_000) <= 0.03 * 25_000
    for r in R.sketch_counts(stored).collect():
        assert abs(r.n_distinct - 2_500) <= 0.03 * 2_500


def test_knn_fold_scores(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(4 * (i % 2), 1), rnd.gauss(0, 1)], float(i % 2)) for i in range(150)]
    folds = M.knn_fold_scores(spark.createDataFrame(rows, "id long, v array<double>, y double"), "id", "v", "y", folds=3)
    assert [r.fold for r in folds.orderBy("fold").collect()] == [0, 1, 2] and folds.agg(F.min("auc")).first()[0] > 0.9


def test_als_takes_ids_beyond_int_and_strings(spark):
    rows = [((1 << 40) + u, f"item{i}", float(1 + (u + i) % 5)) for u in range(12) for i in range(9) if (u + i) % 3]
    df = spark.createDataFrame(rows, "user_id long, item_id string, rating double")
    model = M.fit_als(df, rank=2, iters=3, reg=0.1)
    pairs = spark.createDataFrame([((1 << 40) + 1, "item1"), (5, "item1"), ((1 << 40) + 2, "other")], "user_id long, item_id string")
    got = {(r["user_id"], r["item_id"]): r["pred"] for r in M.predict_pairs(model, pairs, fill=3.7).collect()}
    assert got[(5, "item1")] == 3.7 and got[((1 << 40) + 2, "other")] == 3.7 and got[((1 << 40) + 1, "item1")] != 3.7
    users = df.select("user_id").distinct()
    top = model.recommend(users, 2, df).collect()
    rated = {(r[0], r[1]) for r in rows}
    assert top and all((r["user_id"], r["item_id"]) not in rated and r["rank"] <= 2 for r in top)
    assert len({(r["user_id"], r["item_id"]) for r in top}) == len(top) == 12 * 2


def test_recommend_asks_by_the_users_own_count(spark, monkeypatch):
    """One user has rated nearly all items; the others are not asked for as many."""
    pairs = [(0, i) for i in range(39)] + [(u, i) for u in range(1, 9) for i in range(40) if (u * 7 + i) % 11 == 0]
    df = spark.createDataFrame([(u, i, float(1 + (u + i) % 5)) for u, i in pairs], "user_id long, item_id long, rating double")
    df = df.union(spark.createDataFrame([(9, 39, 2.0)], df.schema))
    model = M.fit_als(df, rank=2, iters=3, reg=0.1)
    ask, asked = type(model.model).recommendForUserSubset, []
    monkeypatch.setattr(type(model.model), "recommendForUserSubset",
                        lambda self, users, n: asked.append((users.count(), n)) or ask(self, users, n))
    got = {}
    for r in model.recommend(df.select("user_id"), 5, df).collect():
        got.setdefault(r["user_id"], []).append((r["rank"], r["pred"]))
    assert sum(c for c, n in asked if n > 20) == 1 and sum(c for c, _ in asked) == 10
    every = df.select("user_id").distinct().crossJoin(df.select("item_id").distinct()).join(df, ["user_id", "item_id"], "left_anti")
    expected = {}
    for r in M.predict_pairs(model, every, fill=None, upper=None).collect():
        expected.setdefault(r["user_id"], []).append(r["pred"])
    assert set(got) == set(expected) == set(range(10))
    for u, preds in expected.items():
        assert [p for _, p in sorted(got[u])] == pytest.approx(sorted(preds, reverse=True)[:5], abs=1e-5)


def test_every_user_gets_recommendations(spark):
    from kiln.plans import catalog
    from kiln.sources import views as V
    users = {r["user_id"] for r in V.ratings_train(spark, "/root/testdata/sf0.001").select("user_id").distinct().collect()}
    top = catalog.QUERIES["recommend_many_users"](spark, "/root/testdata/sf0.001").collect()
    assert {r["user_id"] for r in top} == users and max(r["rank"] for r in top) == 10


def test_importance_is_named_from_the_vector(spark):
    df = spark.createDataFrame([(float(i % 7), "a" if i % 3 else "b", float(i % 2)) for i in range(60)], "x double, c string, label double")
    model, pred = M.fit_predict("forest", df, df, M.feature_pipeline(["x"], ["c"]), "label", numTrees=3)
    names = {r["feature"] for r in M.importance(model, pred, spark).collect()}
    assert {"x", "c_vec_a", "c_vec_b"} <= names


def test_vocabulary_is_not_cut(spark):
    df = spark.createDataFrame([([f"t{i}" for i in range(300)],)], "tokens array<string>")
    cvm, _ = M.count_vectors(df, "tokens", min_df=1.0, idf=False)
    assert len(cvm.stages[0].vocabulary) == 300


def test_fits_take_a_task_per_core_and_folds_stay(spark):
    """Many shuffle partitions are put together, and the folds are those of
    Spark's own cross validation on the rows as they came."""
    from pyspark.ml.tuning import CrossValidator

    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 3000, 1, 8 * cores).selectExpr("id", "double(id % 7) AS a", "double(id % 2) AS label")
    kept = M.for_fits(rows)
    assert kept.rdd.getNumPartitions() == cores and kept.count() == 3000
    kept.unpersist()
    few = M.for_fits(rows.coalesce(2))
    assert few.rdd.getNumPartitions() == 2
    few.unpersist()
    seen = []
    fold = M._DrawnFolds._kFold
    try:
        M._DrawnFolds._kFold = lambda self, df: [seen.append((a.rdd.getNumPartitions(), sorted(r.id for r in b.collect()))) or (a, b)
                                                for a, b in fold(self, df)]
        model = M.cross_val(rows, "logreg", M.feature_pipeline(["a"]), "label", folds=3, seed=5)
    finally:
        M._DrawnFolds._kFold = fold
    assert len(model.avgMetrics) == 1 and [n for n, _ in seen] == [cores] * 3
    want = CrossValidator(numFolds=3, seed=5)._kFold(rows)
    assert [ids for _, ids in seen] == [sorted(r.id for r in b.collect()) for _, b in want]
