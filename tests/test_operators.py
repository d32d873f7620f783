"""Operators on small literal tables with hand-worked answers: empty input,
one row, NULLs, ties, unseen ids, zero variance."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from kiln.operators import clean as CL
from kiln.operators import features as FE
from kiln.operators import recommend as RC
from kiln.operators import report as R
from kiln.operators import sampling as SM
from kiln.operators import series as SE
from kiln.operators import similarity as SI
from kiln.operators import simjoin as SJ
from kiln.operators import stats as ST
from kiln.operators import text as TX
from kiln.operators.prefix import dense_index, running_sum


def test_running_sum_exact_with_many_partitions(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"), F.lit(1).alias("one"))
    out = running_sum(df, ["v"], ["one", "v"], keys=["k"], parts=13).collect()
    for r in out:
        # rows of key k with value <= v
        assert r["cum_one"] == r["v"] // 3 + 1
        assert r["cum_v"] == sum(range(r["k"], r["v"] + 1, 3))


def test_running_sum_empty(spark):
    df = spark.createDataFrame([], "v long, one int")
    assert running_sum(df, ["v"], ["one"]).count() == 0


def test_dense_index_is_dense_and_sorted(spark):
    df = spark.createDataFrame([(5,), (3,), (5,), (None,), (9,)], "x int")
    got = {r["x"]: r["x_idx"] for r in dense_index(df, "x", parts=3).collect()}
    assert got == {3: 0, 5: 1, 9: 2}


def test_conditional_share_zero_fill(spark):
    df = spark.createDataFrame([("a", "NONE "), ("a", "X"), ("b", "X")], "c string, r string")
    got = {r["c"]: (r["total"], r["matched"], r["matched_pct"])
           for r in R.conditional_share(df, "c", F.trim("r") == "NONE").collect()}
    assert got == {"a": (2, 1, 50.0), "b": (1, 0, 0.0)}


def test_shares_and_shares_within(spark):
    df = spark.createDataFrame([(0, "x"), (0, "y"), (1, "x"), (1, "x")], "cls int, v string")
    s = {r["v"]: r["pct"] for r in R.shares(df, "v").collect()}
    assert s == {"x": 75.0, "y": 25.0}
    w = {(r["cls"], r["v"]): r["pct"] for r in R.shares_within(df, "v", "cls").collect()}
    assert w == {(0, "x"): 50.0, (0, "y"): 50.0, (1, "x"): 100.0}


def test_counts_tie_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "k string")
    assert [r["k"] for r in R.counts(df, "k").collect()] == ["c", "a", "b"]


def test_histogram_constant_column(spark):
    df = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    rows = R.histogram(df, "x", 4).collect()
    assert [(r["bin"], r["n"]) for r in rows] == [(0, 2)]


def test_exact_quantiles_match_linear_interpolation(spark):
    vals = [1.0, 2.0, 2.0, 10.0, 4.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    q = {r["p"]: r["q"] for r in ST.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.9, 1.0]).collect()}
    s = sorted(vals)

    def lin(p):
        pos = p * (len(s) - 1)
        lo, hi = math.floor(pos), math.ceil(pos)
        return s[lo] + (s[hi] - s[lo]) * (pos - lo)
    for p, v in q.items():
        assert v == pytest.approx(lin(p))


def test_safe_corr_zero_variance_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert df.agg(ST.safe_corr("a", "b").alias("r")).first()["r"] is None


def test_ks_identical_and_disjoint(spark):
    same = spark.createDataFrame([(float(i), i % 2) for i in range(20)], "x double, c int")
    disjoint = spark.createDataFrame([(float(i), int(i >= 10)) for i in range(20)], "x double, c int")
    assert ST.ks_two_sample(disjoint, ["x"], "c").first()["d"] == 1.0
    assert ST.ks_two_sample(same, ["x"], "c").first()["d"] <= 0.1


def test_auc_perfect_tied_and_random(spark):
    perfect = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.1), (0, 0.2)], "y int, s double")
    tied = spark.createDataFrame([(1, 0.5), (0, 0.5)], "y int, s double")
    assert ST.auc(perfect, "y", "s").first()["auc"] == 1.0
    assert ST.auc(tied, "y", "s").first()["auc"] == 0.5


def test_threshold_sweep_bounds(spark):
    df = spark.createDataFrame([(1, 0.015), (0, 0.01), (1, 1.0)], "y int, s double")
    rows = {round(r["threshold"], 3): r for r in ST.threshold_sweep(df, "y", "s").collect()}
    assert len(rows) == 201
    assert rows[0.0]["tp"] == 2 and rows[0.0]["fp"] == 1
    assert rows[0.015]["tp"] == 2 and rows[0.015]["fp"] == 0   # 0.015 >= 0.015
    assert rows[1.0]["tp"] == 1


def test_confusion_scores_null_on_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    s = ST.binary_scores(ST.confusion(df, "y", "p")).first()
    assert s["accuracy"] == 1.0 and s["precision"] is None and s["recall"] is None


def test_rule_label_three_valued(spark):
    df = spark.createDataFrame([("the cat on",), ("de la",), ("nothing",)], "t string")
    got = [r["label"] for r in CL.rule_label(df, "t", r"\bthe \w+ on\b", r"\bde\b|\bthe\b").collect()]
    assert got == [1, None, 0]


def test_flag_known_and_fill(spark):
    train = spark.createDataFrame([(1, 10, 4.0)], "user_id long, item_id int, rating double")
    pairs = spark.createDataFrame([(1, 10), (2, 10), (1, 11), (3, 12)], "user_id long, item_id int")
    got = {(r["user_id"], r["item_id"]): (r["user_known"], r["item_known"])
           for r in CL.flag_known(pairs, train).collect()}
    assert got == {(1, 10): (True, True), (2, 10): (False, True), (1, 11): (True, False), (3, 12): (False, False)}


def test_append_latest_replaces_by_key(spark):
    base = spark.createDataFrame([(1, 1, 2.0), (1, 2, 3.0)], "user_id long, item_id int, rating double")
    new = spark.createDataFrame([(1, 1, 5.0), (2, 1, 1.0)], "user_id long, item_id int, rating double")
    got = {(r["user_id"], r["item_id"]): r["rating"] for r in CL.append_latest(base, new, ["user_id", "item_id"]).collect()}
    assert got == {(1, 1): 5.0, (1, 2): 3.0, (2, 1): 1.0}


def test_sample_n_exact_and_stable(spark):
    df = spark.range(0, 500).withColumnRenamed("id", "k")
    a = {r["k"] for r in SM.sample_n(df, 37, "k").collect()}
    b = {r["k"] for r in SM.sample_n(df.repartition(7), 37, "k").collect()}
    assert len(a) == 37 and a == b
    h = {r["k"]: r["h"] for r in df.select("k", SM.key_hash("k", 42).alias("h")).collect()}
    by_hash = sorted(h, key=lambda k: (h[k], k))
    for n in (0, 1, 37, 300, 500, 900):
        assert {r["k"] for r in SM.sample_n(df, n, "k").collect()} == set(by_hash[:n])


def test_hash_split_proportions(spark):
    df = spark.range(0, 20000).withColumnRenamed("id", "k")
    c = {r["split"]: r["count"] for r in SM.hash_split(df, "k", [8, 2]).groupBy("split").count().collect()}
    assert abs(c[0] / 20000 - 0.8) < 0.02


def test_lag_windows_chunk_halo(spark):
    rows = [("a", i, float(i)) for i in range(1, 12)] + [("b", i, float(10 * i)) for i in range(1, 4)]
    df = spark.createDataFrame(rows, "k string, d int, v double")
    out = SE.lag_windows(df, "k", "d", "v", 3, chunk=4).collect()
    a = sorted((r["d"], r["x"], r["y"]) for r in out if r["k"] == "a")
    assert len(a) == 8 and a[0] == (4, [1.0, 2.0, 3.0], 4.0) and a[-1] == (11, [8.0, 9.0, 10.0], 11.0)
    assert [r for r in out if r["k"] == "b"] == []  # only 3 rows: no full window
    for t, chunk in ((5, 4), (9, 2), (3, 1), (4, 100)):
        got = sorted((r["k"], r["d"], r["x"], r["y"]) for r in SE.lag_windows(df, "k", "d", "v", t, chunk=chunk).collect())
        want = sorted((k, vs[i][0], [v for _, v in vs[i - t:i]], vs[i][1]) for k in "ab"
                      for vs in [[(d, v) for kk, d, v in rows if kk == k]] for i in range(t, len(vs)))
        assert got == want


def test_minmax_constant_series_is_null(spark):
    df = spark.createDataFrame([("a", 2.0), ("a", 2.0)], "k string, v double")
    assert {r["scaled"] for r in SE.minmax_by_key(df, "k", "v").collect()} == {None}


def test_jaccard_prefix_filter_equals_brute_force(spark):
    import itertools
    import random
    rnd = random.Random(3)
    sets = {i: set(rnd.sample(range(30), rnd.randint(1, 12))) for i in range(40)}
    sets[40] = set(range(30))  # one token-heavy item
    rows = [(i, u) for i, s in sets.items() for u in s]
    df = spark.createDataFrame(rows, "item int, user int")
    got = {(r["id1"], r["id2"]): r["similarity"] for r in SJ.jaccard_pairs(df, "item", "user", 0.4).collect()}
    want = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        if j >= 0.4:
            want[(a, b)] = round(j, 6)
    assert got == want


def test_knn_cells_equal_brute_force(spark):
    import random
    rnd = random.Random(1)
    pts = [(i, [float(rnd.randint(0, 6)) for _ in range(2)], i % 3) for i in range(120)]
    df = spark.createDataFrame(pts, "id long, v array<double>, label long")
    train, test = df.filter("id % 4 <> 0"), df.filter("id % 4 = 0")
    d2 = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for k, pivots, block in ((3, 1, 1000), (3, 8, 4), (7, 64, 2), (200, 8, 4)):
        got = sorted((r["id"], r["rank"], r["neighbour"], r["sq_dist"]) for r in SI.knn_neighbours(
            test, train, "id", "v", "label", k, pivots, block).collect())
        want = sorted((q[0], n + 1, t[0], d2(q[1], t[1])) for q in pts if q[0] % 4 == 0
                      for n, t in enumerate(sorted((t for t in pts if t[0] % 4), key=lambda t: (d2(q[1], t[1]), t[0]))[:k]))
        assert got == want
    assert SI.knn_neighbours(test, train.filter("1 = 0"), "id", "v", "label", 3).count() == 0


def test_knn_distance_votes(spark):
    n = spark.createDataFrame([(1, 0, 0, 1.0), (1, 1, 1, 4.0), (1, 2, 1, 9.0), (2, 0, 0, 0.0), (2, 1, 1, 0.01), (2, 2, 1, 0.01)],
                              "id long, neighbour long, neighbour_label long, sq_dist double")
    assert {r["id"]: r["prediction"] for r in SI.knn_vote(n, "id", "distance").collect()} == {1: 0, 2: 0}
    assert {r["id"]: r["prediction"] for r in SI.knn_vote(n, "id").collect()} == {1: 1, 2: 1}


def test_running_sum_keeps_the_callers_cache(spark):
    from kiln.operators.prefix import running_sum
    df = spark.range(50).withColumn("one", F.lit(1)).persist()
    assert running_sum(df, ["id"], ["one"]).agg(F.max("cum_one")).first()[0] == 50
    assert df.storageLevel.useMemory
    df.unpersist()


def test_one_hot_of_null_is_zero_and_has_no_limit(spark):
    df = spark.createDataFrame([(None,), *[(f"v{i}",) for i in range(70)]], "c string")
    out = FE.one_hot(df, "c")
    assert len(out.columns) == 70 and sorted(sum(r) for r in out.collect()) == [0] + [1] * 70


def test_large_class_counts_do_not_overflow(spark):
    big = 4_000_000_000
    per = spark.createDataFrame([(0.1, 0, big), (0.9, big, 0)], "score double, pos long, neg long")
    total = per.agg(F.sum("pos").cast("double") * F.sum("neg")).first()[0]
    assert total == float(big) * big


def test_assign_to_centres_tie_goes_to_lower_index(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([2.0, 0.0],)], "v array<double>")
    got = [r["cluster"] for r in SI.assign_to_centres(df, "v", [[1.0, 0.0], [-1.0, 0.0], [3.0, 0.0]]).collect()]
    assert got == [0, 0]


def test_user_knn_cold_rules(spark):
    train = spark.createDataFrame([(1, 10, 4.0), (1, 11, 2.0), (2, 10, 5.0), (2, 11, 1.0), (3, 10, 3.0)],
                                  "user_id long, item_id int, rating double")
    pairs = spark.createDataFrame([(9, 10), (1, 99), (3, 11)], "user_id long, item_id int")
    got = {(r["user_id"], r["item_id"]): r["pred"] for r in RC.user_knn(train, pairs).collect()}
    assert got[(9, 10)] == 3.5              # unknown user
    assert got[(1, 99)] == 3.0              # unknown item -> user mean
    # user 3 rated only item 10; raters of 11 are users 1, 2 with no co-rated
    # variance -> weight 1.0; ra = 3.0; d1 = 2 - 4 = -2, d2 = 1 - 5 = -4
    assert got[(3, 11)] == pytest.approx(3.0 + (-2 - 4) / 2)


def test_item_mean_baseline_rules(spark):
    train = spark.createDataFrame([(1, 10, 4.0), (2, 10, 2.0), (2, 11, 5.0)], "user_id long, item_id int, rating double")
    pairs = spark.createDataFrame([(1, 11), (9, 10), (1, 99), (9, 99)], "user_id long, item_id int")
    got = {(r["user_id"], r["item_id"]): r["pred"] for r in RC.item_mean_baseline(train, pairs).collect()}
    assert got == {(1, 11): 5.0, (9, 10): 3.0, (1, 99): 4.0, (9, 99): 3.5}


def test_tokens_stopwords_keep_repeats(spark):
    df = spark.createDataFrame([(1, "The cat, the CAT!! été"), (2, "")], "id long, t string")
    t = TX.drop_stopwords(TX.tokens(df, "t"), "tokens", ["the"])
    got = {r["id"]: r["tokens"] for r in t.collect()}
    assert got == {1: ["cat", "cat", "t"], 2: []}
    assert TX.nonempty(t, "tokens").count() == 1


def test_tfidf_single_doc_norm(spark):
    df = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["b"])], "doc long, tokens array<string>")
    w = {(r["doc"], r["term"]): r["weight"] for r in TX.tfidf(df, "doc", "tokens").collect()}
    idf_a, idf_b = math.log(3 / 2) + 1, math.log(3 / 3) + 1
    n1 = math.hypot(2 * idf_a, idf_b)
    assert w[(1, "a")] == pytest.approx(round(2 * idf_a / n1, 6))
    assert w[(2, "b")] == 1.0


def test_stemmer_examples():
    from kiln.functions.stem import stem
    assert [stem(w) for w in ["caresses", "ponies", "running", "relational", "hopeful", "agreed"]] == \
        ["caress", "poni", "run", "relat", "hope", "agre"]


def _random_sets(spark, hot_token: bool):
    import random
    rnd = random.Random(3)
    rows = []
    for i in range(80):
        base = rnd.sample(range(200), rnd.randint(1, 25)) if i % 4 else list(range(i, i + 20))
        rows += [(i, t) for t in base] + ([(i, 999)] if hot_token else [])
    return rows, spark.createDataFrame(rows, "item int, tok int")


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 1.0])
def test_jaccard_join_equals_all_pairs(spark, threshold):
    rows, df = _random_sets(spark, hot_token=True)
    sets = {}
    for i, t in rows:
        sets.setdefault(i, set()).add(t)
    expected = {(a, b, round(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 6)) for a in sets for b in sets
                if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold}
    assert {tuple(r) for r in SJ.jaccard_pairs(df, "item", "tok", threshold).collect()} == expected


def test_jaccard_bounds_leave_few_candidates(spark):
    """A token held by all items joins nobody by itself, and the bounds keep
    candidates near the number of results."""
    _, df = _random_sets(spark, hot_token=True)
    _, prefix = SJ.jaccard_index(df, "item", "tok", 0.8)
    cand = SJ.jaccard_candidates(prefix, "item", "tok", 0.8).count()
    found = SJ.jaccard_pairs(df, "item", "tok", 0.8).count()
    assert found <= cand <= found + 40 < 80 * 79 / 2 / 20


@pytest.mark.parametrize("threshold", [0.3, 0.7, 0.95])
def test_cosine_join_equals_all_pairs(spark, threshold):
    import math
    import random
    rnd = random.Random(5)
    vectors = {d: {t: rnd.choice([0.5, 1.0, 3.0]) for t in rnd.sample(range(60), rnd.randint(1, 12))} for d in range(70)}
    vectors[70], vectors[71] = dict(vectors[3]), {**vectors[3], 59: 0.5}
    df = spark.createDataFrame([(d, t, w) for d, v in vectors.items() for t, w in v.items()], "doc int, term int, weight double")
    norm = {d: math.sqrt(sum(w * w for w in v.values())) for d, v in vectors.items()}
    expected = {}
    for a in vectors:
        for b in vectors:
            if a < b:
                c = round(sum(w * vectors[b].get(t, 0.0) for t, w in vectors[a].items()) / norm[a] / norm[b], 6)
                if c >= threshold:
                    expected[a, b] = c
    got = {(r.doc1, r.doc2): r.cosine for r in SJ.cosine_above(df, threshold).collect()}
    assert got.keys() == expected.keys() and all(abs(got[k] - expected[k]) < 2e-6 for k in got)
    assert SJ.cosine_above(df.filter("1 = 0"), threshold).collect() == []


def test_cosine_candidates_are_checked_in_cells(spark, monkeypatch):
    """Whole vectors go to cells of candidates, not to each candidate."""
    import math
    import random
    rnd = random.Random(6)
    vectors = {d: {f"t{t}": rnd.choice([0.5, 1.0, 3.0]) for t in rnd.sample(range(30), rnd.randint(1, 9))} for d in range(60)}
    unit = {d: {t: w / math.sqrt(sum(x * x for x in v.values())) for t, w in v.items()} for d, v in vectors.items()}
    full = spark.createDataFrame([(d, t, w) for d, v in unit.items() for t, w in v.items()], "doc long, term string, _w double")
    cand = spark.createDataFrame([(a, b) for a in unit for b in unit if a < b], "doc1 long, doc2 long")
    dots = {(a, b): sum(w * unit[b].get(t, 0.0) for t, w in unit[a].items()) for a in unit for b in unit if a < b}
    expected = sorted(p for p, c in dots.items() if c >= 0.4037)
    assert all(abs(c - 0.4037) > 2 * SJ.SINGLE for c in dots.values())
    for terms, pairs in ((1 << 22, 1 << 22), (50, 1 << 22), (50, 100)):
        monkeypatch.setattr(SJ, "CELL_TERMS", terms)
        monkeypatch.setattr(SJ, "CELL_PAIRS", pairs)
        near = SJ.cosine_checked(cand, full, "doc", "term", 0.4037)
        assert sorted((r.doc1, r.doc2) for r in near.collect()) == expected
    none = SJ.cosine_checked(cand.filter("1 = 0"), full, "doc", "term", 0.4037)
    assert none.collect() == []


def test_cosine_pairs_with_short_rests_are_not_made(spark):
    """Two vectors whose rests are too short where they meet are no candidates."""
    rows = [(d, t, w, tail) for d in (1, 2) for t, w, tail in (("x", 0.3, 0.85),)] + [
        (3, "y", 0.3, 0.95), (4, "y", 0.3, 0.95), (5, "x", 0.3, 0.95)]
    prefix = spark.createDataFrame(rows, "doc long, term string, _w double, _tail double")
    got = sorted(tuple(r) for r in SJ.cosine_candidates(prefix, "doc", "term", 0.8).collect())
    assert got == [(1, 5), (2, 5), (3, 4)]


def test_rater_similarity_is_user_similarity_of_the_needed_pairs(spark):
    import random
    rnd = random.Random(8)
    kind = "user_id long, item_id int, rating double"
    train = spark.createDataFrame([(u, i, None if rnd.random() < 0.1 else float(rnd.randint(1, 5)))
                                   for u in range(25) for i in range(12) if rnd.random() < 0.4], kind)
    asked = spark.createDataFrame([(u, rnd.randint(0, 13)) for u in range(20, 30) for _ in range(3)] + [(3, 3)] * 2, "user_id long, item_id int")
    pairs = asked.select(F.col("user_id").alias("a"), "item_id").join(
        train.select(F.col("user_id").alias("b"), "item_id"), "item_id").select("a", "b").distinct()
    got = RC.rater_similarity(train, asked)
    assert sorted(got.collect()) == sorted(RC.user_similarity(train, pairs).collect())
    made = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in made[:made.index("Generate")]  # nothing is looked up for the pairs once they are made
