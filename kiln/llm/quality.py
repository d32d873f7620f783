"""Quality rules: robust multivariate outliers.

Per text a vector of transformed statistics is taken (``FEATURES``). Texts
that fail the base rules are left out; on the others a minimum covariance
determinant (MCD) estimate is made for each language and source: the share
``H`` of its texts whose covariance has the least determinant, found by
concentration steps from two deterministic starts (median with interquartile
ranges; median with the floors), of which the one with the lesser determinant
counts. A text is rejected if its squared Mahalanobis distance to its group
exceeds the chi-square quantile ``REJECT``.

A group of fewer than ``MIN_GROUP`` texts uses the estimate of its language,
and that of the whole corpus if the language is small, too; a corpus smaller
than that rejects nothing. Each feature's variance has a floor, so that a
statistic that is equal in most texts (no symbols at all) neither makes the
covariance singular nor lets a small deviation reject a text.

All of it is aggregates. A concentration step reads the vectors once and sums
them per group and bin of the distance; the bins up to the share ``H`` are
then added up in a table of a few hundred rows per group. Bins are fixed, so
the result does not depend on the order of rows. A hot language or source is
only ever summed, and its texts meet the estimates through ``join_hot``.

Defined results: a null text has no words and fails the base; a null language
or source is a group of its own; repeated rows count each; an empty table
gives no rows; other columns are carried by ``good_documents``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import SEPARATORS, fresh, hot_keys, join_hot, work_dir, word_array, written

SYMBOLS = r"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
H = 0.75
STEPS = 4
MIN_GROUP = 200
REJECT = 1 - 1e-9
#: Feature -> least standard deviation. Length and word length are logarithms,
#: the others square roots of a share of the words (``marks``: of the characters).
FEATURES = {"length": 0.5, "word_chars": 0.03, "symbols": 0.05, "dup_lines": 0.1, "repeats": 0.15, "marks": 0.03}
N = len(FEATURES)
GRID = 200  # cells of a feature's unit, for its quartiles
BINS = 48  # bins of a distance per factor e
X = [f"x{i}" for i in range(N)]
PAIRS = [(i, j) for i in range(N) for j in range(i + 1)]


def base_statistics(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` without its text and with n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, marks (ASCII punctuation), base_failed.

    Repeated words: each 3-word window becomes one long, its hash with the low
    bits replaced by its place; in sorted order equal windows are neighbours,
    whose words are then compared themselves. The places found, sorted, cover
    min(3, gap to the next place) words each."""
    words, low, order, at, lines = fresh(df, "words", "low", "order", "at", "lines")
    t = F.coalesce(F.col(text_col), F.lit(""))
    others = [c for c in df.columns if c != text_col]
    count = lambda chars: (F.length(t) - F.length(F.regexp_replace(t, f"[{chars}]+", ""))).cast("long")
    df = df.select(
        *others, word_array(t).alias(words),
        F.length(F.regexp_replace(t, f"[{SEPARATORS}]+", "")).cast("long").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"), count(r"\p{Punct}").alias("marks"),
        F.filter(F.split(t, "\n", -1), lambda x: F.rlike(x, F.lit(f"[^{SEPARATORS}]"))).alias(lines))
    windows = F.greatest(F.size(words) - 2, F.lit(0))
    df = df.withColumns({"n_words": F.size(words).cast("long"),
                         "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
                         low: F.expr(f"shiftleft(1L, length(bin(size({words})))) - 1")})
    high = F.bitwise_not(F.col(low))
    df = df.withColumn(order, F.sort_array(F.transform(F.slice(words, F.lit(1), windows), lambda w, i: (
        F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(high).bitwiseOR(i.cast("long"))))))

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.col(low)).cast("int")

    def equal(a: Column, b: Column) -> Column:
        same = (a.bitwiseXOR(b).bitwiseAND(high) == 0)
        for k in range(3):
            same = same & (F.get(words, place(a) + k) == F.get(words, place(b) + k))
        return F.coalesce(same, F.lit(False))

    df = df.withColumn(at, F.sort_array(F.transform(
        F.filter(order, lambda x, i: equal(x, F.get(order, i - 1)) | equal(x, F.get(order, i + 1))), place)))
    covered = F.aggregate(F.transform(at, lambda x, i: F.coalesce(F.least(F.get(at, i + 1) - x, F.lit(3)), F.lit(3))),
                          F.lit(0).cast("long"), lambda acc, x: acc + x)
    return (df.withColumn("n_repeat_words", covered).drop(words, low, order, at, lines)
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))))


def _features() -> list[Column]:
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    shares = [F.sqrt(F.col(c) / n) for c in ("n_symbols", "n_dup_lines", "n_repeat_words")]
    return [F.log(n), F.log(chars / n), *shares, F.sqrt(F.col("marks") / chars)]


def chi2_cdf(x: float, df: int) -> float:
    """Chi-square distribution function for an even number of degrees."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(df // 2))


def chi2_quantile(p: float, df: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, df) < p else (lo, mid)
    return hi


#: Makes the covariance of the inner share H consistent for normal data.
SCALE = H / chi2_cdf(chi2_quantile(H, N), N + 2)
LIMIT = chi2_quantile(REJECT, N)


def _factor(est: DataFrame) -> DataFrame:
    """Adds the Cholesky factor l<i><j> of the covariance c<i><j> and the
    logarithm of its determinant."""
    for j in range(N):
        root = F.col(f"c{j}{j}") - sum((F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        est = est.withColumn(f"l{j}{j}", F.sqrt(F.greatest(root, F.lit(1e-12))))
        est = est.withColumns({f"l{i}{j}": (F.col(f"c{i}{j}") - sum(
            (F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))) / F.col(f"l{j}{j}")
            for i in range(j + 1, N)})
    return est.withColumn("log_det", 2 * sum((F.log(f"l{i}{i}") for i in range(N)), F.lit(0.0)))


_ESTIMATE = [*[f"m{i}" for i in range(N)], *[f"l{i}{j}" for i, j in PAIRS]]


def _distance(df: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance, by forward substitution."""
    for i in range(N):
        y = F.col(f"x{i}") - F.col(f"m{i}") - sum((F.col(f"l{i}{j}") * F.col(f"y{j}") for j in range(i)), F.lit(0.0))
        df = df.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
    return df.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(N)), F.lit(0.0)))


def _starts(vectors: DataFrame) -> DataFrame:
    """Per group the two starts: median, and interquartile ranges or floors."""
    cells = vectors.select("g", F.posexplode(F.array(*[F.round(F.col(x) * GRID).cast("long") for x in X])).alias("i", "cell"))
    counts = cells.groupBy("g", "i", "cell").agg(F.count(F.lit(1)).alias("n"))
    up_to = Window.partitionBy("g", "i").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("g", "i")
    ranked = counts.withColumns({"upto": F.sum("n").over(up_to), "all": F.sum("n").over(whole)})
    at = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("cell"))) / GRID
    q = ranked.groupBy("g", "i").agg(at(0.25).alias("lo"), at(0.5).alias("mid"), at(0.75).alias("hi"),
                                     F.first("all").alias("n"))
    wide = q.groupBy("g").agg(F.first("n").alias("n"), *[F.max(F.when(F.col("i") == i, F.col(c))).alias(f"{c}{i}")
                                                        for i in range(N) for c in ("lo", "mid", "hi")])
    floors = list(FEATURES.values())
    one = wide.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    spread = {f"c{i}{i}": F.when(F.col("start") == 0, F.pow((F.col(f"hi{i}") - F.col(f"lo{i}")) / 1.349, 2))
              .otherwise(0.0) + floors[i] ** 2 for i in range(N)}
    one = one.withColumns(spread | {f"c{i}{j}": F.lit(0.0) for i, j in PAIRS if i != j})
    return _factor(one.withColumns({f"m{i}": F.col(f"mid{i}") for i in range(N)})).select("g", "start", "n", "log_det", *_ESTIMATE)


def _concentrate(vectors: DataFrame, est: DataFrame, hot: list) -> DataFrame:
    """One concentration step for all groups and starts; ``hot``: see join_hot."""
    both = est.groupBy("g").agg(F.collect_list(F.struct("start", "n", *_ESTIMATE)).alias("starts"))
    met = join_hot(vectors, both, ["g"], hot=hot).select("g", *X, F.inline("starts"))
    met = _distance(met).withColumn("bin", F.floor(F.log(F.col("d2") + 1e-6) * BINS))
    sums = [F.count(F.lit(1)).alias("k"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(X)],
            *[F.sum(F.col(X[i]) * F.col(X[j])).alias(f"p{i}{j}") for i, j in PAIRS]]
    bins = met.groupBy("g", "start", "n", "bin").agg(*sums)
    before = Window.partitionBy("g", "start").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    inner = bins.withColumn("before", F.coalesce(F.sum("k").over(before), F.lit(0))).filter(F.col("before") < H * F.col("n"))
    out = inner.groupBy("g", "start", "n").agg(*[F.sum(c).alias(c) for c in
                                                 ["k", *[f"s{i}" for i in range(N)], *[f"p{i}{j}" for i, j in PAIRS]]])
    out = out.withColumns({f"m{i}": F.col(f"s{i}") / F.col("k") for i in range(N)})
    floors = list(FEATURES.values())
    out = out.withColumns({f"c{i}{j}": (F.col(f"p{i}{j}") / F.col("k") - F.col(f"m{i}") * F.col(f"m{j}")) * SCALE
                           + (floors[i] ** 2 if i == j else 0.0) for i, j in PAIRS})
    return _factor(out).select("g", "start", "n", "log_det", *_ESTIMATE)


def _group(level: int) -> Column:
    """Key of a text's group: 2 language and source, 1 language, 0 all. Nulls
    are left out of the JSON text and so differ from every value."""
    return F.to_json(F.struct(F.lit(level).alias("level"), *[F.col(c) for c in ("lang", "source")[:level]]))


def estimates(good: DataFrame) -> DataFrame:
    """The MCD estimate of each group of at least MIN_GROUP texts in ``good``
    (lang, source, x0, x1, ...), by ``g``."""
    spark = good.sparkSession
    vectors = written(good.select(F.explode(F.array(*[_group(k) for k in range(3)])).alias("g"), *X), work_dir(spark, "vectors"))
    est = written(_starts(vectors), work_dir(spark, "mcd"))
    hot = [hot_keys(vectors, ["g"])]  # the same in every step
    for _ in range(STEPS):
        est = written(_concentrate(vectors, est, hot), work_dir(spark, "mcd"))
    best = est.groupBy("g").agg(F.min_by(F.struct("n", *_ESTIMATE), F.struct("log_det", "start")).alias("e"))
    return best.select("g", "e.*").filter(F.col("n") >= MIN_GROUP).drop("n")


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source") -> DataFrame:
    """Per row: id, lang, source, h (hash of id and text), the base statistics,
    base_failed, d2 (null where no group is large enough) and kept."""
    spark = docs.sparkSession
    t = F.col(text_col)
    df = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                     F.xxhash64(F.col(id_col), t).alias("h"), t.alias("text"))
    df = base_statistics(df, "text")
    stats = written(df.withColumns(dict(zip(X, _features()))), work_dir(spark, "statistics"))
    est = written(estimates(stats.filter("NOT base_failed")), work_dir(spark, "estimates"))
    # the estimate that each language and source uses: its own, or that of the next larger group
    kinds = stats.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows"))
    ways = kinds.select("lang", "source", F.posexplode(F.array(*[_group(k) for k in range(3)])).alias("level", "g"))
    chosen = (ways.join(est, "g").groupBy("lang", "source")
              .agg(F.max_by(F.struct(*_ESTIMATE), "level").alias("e")).select("lang", "source", "e.*"))
    met = _distance(join_hot(stats, written(chosen, work_dir(spark, "chosen")), ["lang", "source"], "left"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= LIMIT, F.lit(True))
    return met.withColumn("kept", kept).drop(*X, *_ESTIMATE, *[f"y{i}" for i in range(N)])


def good_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                   source_col: str = "source") -> DataFrame:
    """Rows of ``docs`` that pass, all columns whole. Rows with equal id, text,
    language and source share one verdict."""
    h, k = fresh(docs, "h", "k")
    keys = [id_col, lang_col, source_col]
    kept = (verdicts(docs, id_col, text_col, lang_col, source_col).filter("kept")
            .select("h", "id", "lang", "source").distinct())
    kept = kept.select(F.col("h").alias(f"{k}h"), *[F.col(c).alias(f"{k}{i}") for i, c in enumerate(("id", "lang", "source"))])
    d = docs.withColumn(h, F.xxhash64(F.col(id_col), F.col(text_col)))
    cond = d[h] == kept[f"{k}h"]
    for i, c in enumerate(keys):
        cond = cond & d[c].eqNullSafe(kept[f"{k}{i}"])
    return d.join(kept, cond, "left_semi").drop(h)
