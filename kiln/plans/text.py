"""Text queries on V_comments and V_movies."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions.words import PLOT_STOPWORDS, SPARK_ENGLISH
from kiln.operators import similarity as SI
from kiln.operators import simjoin as SJ
from kiln.operators import text as TX
from kiln.plans.registry import query
from kiln.session import stored
from kiln.sources import views as V

WORD_SPLIT = r"\W"                 # RegexTokenizer pattern of the comment project
PLOT_SPLIT = r"[^\p{L}]+"          # letters only, any alphabet
PLOT_TOKEN = r"[^\p{L}\p{N}']+"    # words with digits and apostrophes kept
MIN_DF, MAX_DF, MAX_TERMS = 0.1, 0.8, 2000
LIKE_T = 0.8                       # least cosine of like plots


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


ENGLISH_SQL = _sql_list(SPARK_ENGLISH)
_PLOT = _sql_list(PLOT_STOPWORDS)
COMMENT_TOKENS = rf"list_filter(regexp_split_to_array(lower(comment), '{WORD_SPLIT}'), lambda x: x <> '')"


def _comment_tokens(spark, sf):
    return TX.tokens(V.comments(spark, sf), "comment", WORD_SPLIT)


def _comment_filtered(spark, sf):
    return TX.drop_stopwords(_comment_tokens(spark, sf), "tokens", SPARK_ENGLISH, "filtered")


@query("tokenize", f"SELECT comment_id, {COMMENT_TOKENS} AS tokens FROM v_comments")
def tokenize(spark, sf):
    """Split every comment on non-word characters."""
    return _comment_tokens(spark, sf).select("comment_id", "tokens")


@query("remove_stopwords", f"""
SELECT comment_id, list_filter({COMMENT_TOKENS}, lambda x: NOT list_contains({ENGLISH_SQL}, x)) AS filtered
FROM v_comments""")
def remove_stopwords(spark, sf):
    """Drop Spark's English stop words, repeats and order kept."""
    return _comment_filtered(spark, sf).select("comment_id", "filtered")


@query("nonempty_tokens", f"""
SELECT comment_id, CAST(len({COMMENT_TOKENS}) AS BIGINT) AS n_tokens FROM v_comments
WHERE len({COMMENT_TOKENS}) > 0""")
def nonempty_tokens(spark, sf):
    """Comments with at least one word token."""
    t = TX.nonempty(_comment_tokens(spark, sf), "tokens")
    return t.select("comment_id", F.size("tokens").cast("long").alias("n_tokens"))


@query("word_count", f"""
SELECT word, count(*) AS n FROM (
  SELECT unnest(list_filter({COMMENT_TOKENS}, lambda x: NOT list_contains({ENGLISH_SQL}, x))) AS word FROM v_comments)
GROUP BY word""")
def word_count(spark, sf):
    """Word frequencies over all comments after stop-word removal."""
    return TX.word_counts(_comment_filtered(spark, sf), "filtered")


@query("alpha_tokens", rf"""
SELECT movie_id,
       list_filter(regexp_split_to_array(lower(plot), '{PLOT_TOKEN.replace("'", "''")}'),
                   lambda x: x <> '' AND NOT list_contains({_PLOT}, x) AND regexp_matches(x, '[a-zA-Z]')) AS tokens
FROM v_movies""")
def alpha_tokens(spark, sf):
    """N1-N3 for plots: split, drop the plot stop words, keep tokens with a letter."""
    t = TX.tokens(V.movies(spark, sf), "plot", PLOT_TOKEN)
    t = TX.keep_alpha(TX.drop_stopwords(t, "tokens", PLOT_STOPWORDS), "tokens")
    return t.select("movie_id", "tokens")


def plot_terms(spark, sf):
    t = TX.tokens(V.movies(spark, sf), "plot", PLOT_SPLIT)
    return TX.drop_stopwords(t, "tokens", PLOT_STOPWORDS)


_TFIDF_CTES = rf"""
tok AS (SELECT movie_id, unnest(list_filter(regexp_split_to_array(lower(plot), '{PLOT_SPLIT}'),
                                            lambda x: x <> '' AND NOT list_contains({_PLOT}, x))) AS term
        FROM v_movies),
tf AS (SELECT movie_id, term, count(*) AS tf FROM tok GROUP BY movie_id, term),
nd AS (SELECT count(DISTINCT movie_id) AS n FROM v_movies),
st AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY term),
keep AS (SELECT term, df FROM st, nd
         WHERE df >= n * CAST({MIN_DF} AS DOUBLE) AND df <= n * CAST({MAX_DF} AS DOUBLE)
         ORDER BY total DESC, term LIMIT {MAX_TERMS}),
w AS (SELECT tf.movie_id, tf.term, tf.tf, keep.df,
             tf.tf * (ln((nd.n + CAST(1 AS DOUBLE)) / (keep.df + CAST(1 AS DOUBLE))) + CAST(1 AS DOUBLE)) AS w
      FROM tf JOIN keep ON tf.term = keep.term, nd),
nrm AS (SELECT movie_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY movie_id),
tw AS (SELECT w.movie_id, w.term, w.tf, w.df, w.w / nrm.norm AS weight FROM w JOIN nrm ON w.movie_id = nrm.movie_id)"""


@query("tfidf_long", f"""
WITH {_TFIDF_CTES}
SELECT movie_id, term, tf, df, round(weight, 6) AS weight FROM tw""")
def tfidf_long(spark, sf):
    """Smoothed, L2-normalised TF-IDF of plots, document frequency
    0.1-0.8, at most 2,000 terms."""
    return TX.tfidf(plot_terms(spark, sf), "movie_id", "tokens", MIN_DF, MAX_DF, MAX_TERMS)


@query("cluster_terms", f"""
WITH {_TFIDF_CTES},
g AS (SELECT m.lang, tw.term, round(sum(tw.weight), 6) AS weight
      FROM tw JOIN v_movies m ON tw.movie_id = m.movie_id GROUP BY m.lang, tw.term)
SELECT lang, term, weight, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY weight DESC, term) AS rank FROM g)
WHERE rank <= 10""")
def cluster_terms(spark, sf):
    """Ten heaviest TF-IDF terms per language group."""
    w = TX.tfidf(plot_terms(spark, sf), "movie_id", "tokens", MIN_DF, MAX_DF, MAX_TERMS, digits=None)
    g = w.join(V.movies(spark, sf).select("movie_id", "lang"), "movie_id")
    return TX.top_terms(g, "lang", 10).select("lang", "term", "weight", F.col("rank").cast("long").alias("rank"))


@query("doc_cosine", f"""
WITH {_TFIDF_CTES},
recent AS (SELECT movie_id FROM v_movies ORDER BY year DESC, movie_id LIMIT 100),
r AS (SELECT * FROM tw WHERE movie_id IN (SELECT movie_id FROM recent)),
n2 AS (SELECT movie_id, sqrt(sum(weight * weight)) AS nn FROM r GROUP BY movie_id),
x AS (SELECT r.movie_id, r.term, r.weight / n2.nn AS w FROM r JOIN n2 ON r.movie_id = n2.movie_id)
SELECT a.movie_id AS doc1, b.movie_id AS doc2, round(sum(a.w * b.w), 6) AS cosine
FROM x a JOIN x b ON a.term = b.term AND a.movie_id < b.movie_id GROUP BY a.movie_id, b.movie_id""")
def doc_cosine(spark, sf):
    """Cosine between the TF-IDF vectors of the 100 most recent plots
    (the limit is the feature: the reference compares exactly those)."""
    w = TX.tfidf(plot_terms(spark, sf), "movie_id", "tokens", MIN_DF, MAX_DF, MAX_TERMS, digits=None)
    recent = V.movies(spark, sf).orderBy(F.desc("year"), "movie_id").limit(100).select("movie_id")
    r = w.join(F.broadcast(recent), "movie_id")
    out = SI.cosine_sparse(r, doc="movie_id", term="term", weight="weight")
    return out


_LIKE_CTES = rf"""
words AS (SELECT movie_id, list_filter(regexp_split_to_array(lower(plot), '{PLOT_SPLIT}'),
                                       lambda x: x <> '' AND NOT list_contains({_PLOT}, x)) AS tokens FROM v_movies),
reps AS (SELECT min(movie_id) AS movie_id, count(*) AS copies, any_value(tokens) AS tokens FROM words
         WHERE len(tokens) > 0 GROUP BY array_to_string(tokens, ' ')),
tok AS (SELECT movie_id, unnest(tokens) AS term FROM reps),
tf AS (SELECT movie_id, term, count(*) AS tf FROM tok GROUP BY movie_id, term),
nd AS (SELECT count(*) AS n FROM reps),
st AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT tf.movie_id, tf.term, round(tf.tf * (ln((nd.n + CAST(1 AS DOUBLE)) / (st.df + CAST(1 AS DOUBLE)))
             + CAST(1 AS DOUBLE)), 6) AS w FROM tf JOIN st ON tf.term = st.term, nd),
nrm AS (SELECT movie_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY movie_id),
u AS (SELECT w.movie_id, w.term, w.w / nrm.norm AS w FROM w JOIN nrm ON w.movie_id = nrm.movie_id)"""


@query("cosine_above", f"""
WITH {_LIKE_CTES},
p AS (SELECT a.movie_id AS doc1, b.movie_id AS doc2, round(sum(a.w * b.w), 6) AS cosine
      FROM u a JOIN u b ON a.term = b.term AND a.movie_id < b.movie_id GROUP BY a.movie_id, b.movie_id)
SELECT doc1, doc2, cosine, x.copies AS copies1, y.copies AS copies2
FROM p JOIN reps x ON x.movie_id = doc1 JOIN reps y ON y.movie_id = doc2 WHERE cosine >= {LIKE_T}""")
def cosine_above(spark, sf):
    """T7 over all plots: pairs of different texts with cosine >= 0.8. Texts
    with the same words are one row, named by their least id, with their
    number of copies, so a large group of copies is no quadratic result."""
    words = plot_terms(spark, sf).filter(F.size("tokens") > 0).select("movie_id", "tokens")
    reps = stored(words.groupBy(F.array_join("tokens", " ").alias("text"))
                  .agg(F.min("movie_id").alias("movie_id"), F.count(F.lit(1)).alias("copies")), "distinct-texts")
    w = TX.tfidf(reps.withColumn("tokens", F.split("text", " ")), "movie_id", "tokens", norm=False)
    pairs = SJ.cosine_above(w, LIKE_T, doc="movie_id")
    copies = reps.select("movie_id", "copies")
    for k in (1, 2):
        pairs = pairs.join(copies.select(F.col("movie_id").alias(f"doc{k}"), F.col("copies").alias(f"copies{k}")), f"doc{k}")
    return pairs.select("doc1", "doc2", "cosine", "copies1", "copies2")


@query("count_idf_long", f"""
WITH tok AS (SELECT comment_id,
                    unnest(list_filter({COMMENT_TOKENS}, lambda x: NOT list_contains({ENGLISH_SQL}, x))) AS term
             FROM v_comments),
tf AS (SELECT comment_id, term, count(*) AS tf FROM tok GROUP BY comment_id, term),
nd AS (SELECT count(DISTINCT comment_id) AS n FROM v_comments),
st AS (SELECT term, count(*) AS df FROM tf GROUP BY term HAVING count(*) >= 2)
SELECT tf.comment_id, tf.term, tf.tf, st.df,
       round(tf.tf * ln((nd.n + CAST(1 AS DOUBLE)) / (st.df + CAST(1 AS DOUBLE))), 6) AS weight
FROM tf JOIN st ON tf.term = st.term, nd""")
def count_idf_long(spark, sf):
    """Term counts weighted by Spark's IDF, terms in >= 2 comments."""
    return TX.count_idf(_comment_filtered(spark, sf), "comment_id", "filtered", min_doc_freq=2)


@query("stem_vocabulary")
def stem_vocabulary(spark, sf):
    """Plot vocabulary -> stem -> most frequent surface word."""
    t = TX.keep_alpha(plot_terms(spark, sf), "tokens")
    return TX.stem_vocabulary(t, "tokens")
