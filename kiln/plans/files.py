"""Source and sink queries (S1-S6, S9-S11): the driver's tables through files
and models in the shared scratch folder, and a SQL view."""

from __future__ import annotations

import uuid

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kiln.operators import models as M
from kiln.plans.registry import query
from kiln.session import scratch_path
from kiln.sources import files as FS
from kiln.sources import views as V
from kiln.sources.tables import load, spread


@query("csv_roundtrip", """
SELECT doc_id, lang, CAST(length(text) AS BIGINT) AS n_chars_read FROM documents""")
def csv_roundtrip(spark, sf):
    """Write every document (quoted commas, doubled quotes, line
    breaks inside fields) as CSV with a header, read it back with the
    declared-schema multi-line reader and measure the whole texts."""
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    docs = spread(load(spark, sf, "documents").select("doc_id", "lang", "text"), "doc_id")
    FS.write_predictions(docs, path)
    back = FS.read_multiline_csv(spark, path, "doc_id long, lang string, text string", ["doc_id", "lang", "text"])
    return back.select("doc_id", "lang", F.length("text").cast("long").alias("n_chars_read"))


@query("delimited_ratings", "SELECT user_id, item_id, rating FROM v_ratings_all")
def delimited_ratings(spark, sf):
    """All ratings as a gzip file set with a header, read back with a
    declared schema."""
    path = scratch_path(spark, f"ratings-{uuid.uuid4().hex}")
    r = V.ratings_all(spark, sf).select("user_id", "item_id", "rating")
    r.write.option("header", True).option("compression", "gzip").option("maxRecordsPerFile", FS.ROWS_PER_FILE).csv(path)
    return FS.read_delimited(spark, path, r.schema).select("user_id", "item_id", "rating")


@query("symbol_folder", "SELECT name, CAST(count(*) AS BIGINT) AS n, round(avg(price), 4) AS mean FROM v_prices GROUP BY name")
def symbol_folder(spark, sf):
    """Daily prices in a folder per symbol, read as one table with the
    symbol taken from the path."""
    path = scratch_path(spark, f"symbols-{uuid.uuid4().hex}")
    p = V.prices(spark, sf).select("name", "date", "price")
    (p.withColumn("symbol", F.col("name")).write.partitionBy("symbol").option("header", True).csv(path))
    back = FS.read_symbol_folder(spark, f"{path}/*", "name string, date string, price double", "file_symbol",
                                 r"symbol=([^/]+)/")
    back = back.withColumn("name", F.url_decode(F.regexp_replace("file_symbol", r"%25", "%")))
    return back.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("price"), 4).alias("mean"))


@query("model_reload", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS differences FROM v_points")
def model_reload(spark, sf):
    """A classifier saved and loaded again scores every row alike."""
    path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    pts = V.points(spark, sf).select("point_id", array_to_vector("features").alias("features"),
                                     (F.col("label") < 5).cast("double").alias("label"))
    model = M.classifier("logreg").fit(pts)
    FS.save_model(model, path)
    again = FS.load_model(LogisticRegressionModel, path)
    a = model.transform(pts).select("point_id", F.col("prediction").alias("before"))
    b = again.transform(pts).select("point_id", F.col("prediction").alias("after"))
    return a.join(b, "point_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") != F.col("after")).alias("differences"))


@query("sql_view", """
SELECT district, CAST(count(*) AS BIGINT) AS n FROM v_incidents WHERE category = 'purchase' GROUP BY district""")
def sql_view(spark, sf):
    """A SQL statement over a registered view."""
    FS.register_view(V.incidents(spark, sf), "kiln_incidents")
    return spark.sql("SELECT district, count(*) AS n FROM kiln_incidents WHERE category = 'purchase' GROUP BY district")
