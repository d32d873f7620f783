"""Readers, writers and the intake stream."""

from __future__ import annotations

import glob
import gzip
import os
import random

from pyspark.sql import functions as F

from kiln.operators import models as M
from kiln.sources import files as FS
from kiln.streaming import intake as IN
from kiln.streaming.intake import item_stats_stream, read_stats


def _write(path, text, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        with gzip.open(path, "wt", encoding="utf-8") as f:
            f.write(text)
    else:
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)


def test_ratings_with_spaced_header_and_bad_row(spark, tmp_dir):
    p = f"{tmp_dir}/r.csv"
    _write(p, "user_id, business_id, stars\nu1, b1, 4.0\nu2, b1, x\nu2, b2, 5\n")
    df = FS.read_delimited(spark, p, "user_id string, business_id string, stars double")
    rows = df.collect()
    assert len(rows) == 3
    assert [r["stars"] for r in rows] == [4.0, None, 5.0]
    assert rows[1][FS.CORRUPT] is not None and rows[0][FS.CORRUPT] is None
    assert rows[0]["business_id"] == "b1"


def test_quoted_commas_quotes_and_line_breaks(spark, tmp_dir):
    p = f"{tmp_dir}/m.csv"
    _write(p, 'id,title,plot\n1,"Crouching Tiger, Hidden Dragon","He said ""no"".\nThen left."\n2,Plain,Short\n')
    df = FS.read_multiline_csv(spark, p, "id int, title string, plot string", ["id", "title", "plot"])
    got = {r["id"]: (r["title"], r["plot"]) for r in df.collect()}
    assert got[1] == ("Crouching Tiger, Hidden Dragon", 'He said "no".\nThen left.')
    assert got[2] == ("Plain", "Short")


def test_gzip_and_symbol_folder(spark, tmp_dir):
    _write(f"{tmp_dir}/px/AAA_data.csv", "date,close\n2020-01-01,1.5\n2020-01-02,2.5\n")
    _write(f"{tmp_dir}/px/BBB_data.csv", "date,close\n2020-01-01,7.0\n")
    _write(f"{tmp_dir}/gz/c.csv.gz", "a,b\n1,x\n2,y\n", gz=True)
    df = FS.read_symbol_folder(spark, f"{tmp_dir}/px", "date date, close double")
    got = sorted((r["name"], r["close"]) for r in df.collect())
    assert got == [("AAA", 1.5), ("AAA", 2.5), ("BBB", 7.0)]
    assert FS.read_delimited(spark, f"{tmp_dir}/gz", "a int, b string").count() == 2


def test_from_rows_and_prediction_roundtrip(spark, tmp_dir):
    df = FS.from_rows(spark, [("u", "i", 3.5)], "user string, item string, prediction double")
    FS.write_predictions(df, f"{tmp_dir}/pred")
    back = FS.read_delimited(spark, f"{tmp_dir}/pred", "user string, item string, prediction double")
    assert [(r["user"], r["item"], r["prediction"]) for r in back.collect()] == [("u", "i", 3.5)]


def test_csv_files_are_bounded(spark, tmp_dir):
    df = spark.range(0, 1000, 1, 2).selectExpr("id", "concat('line ', id, '\n\"quoted\", second') AS t")
    FS.write_predictions(df, f"{tmp_dir}/parts", rows_per_file=100)
    assert len(glob.glob(f"{tmp_dir}/parts/*.csv")) == 10
    back = FS.read_multiline_csv(spark, f"{tmp_dir}/parts", "id long, t string", ["id", "t"])
    assert back.rdd.getNumPartitions() > 1 and sorted(back.collect()) == sorted(df.collect())


def test_model_save_and_load(spark, tmp_dir):
    r = spark.createDataFrame([(i % 5, i % 7, float(i % 3 + 1)) for i in range(60)],
                              "user_id long, item_id int, rating double")
    m = M.fit_als(r, rank=2, iters=3, reg=0.1)
    FS.save_model(m, f"{tmp_dir}/als")
    m2 = FS.load_model(M.IndexedAls, f"{tmp_dir}/als")
    a = M.predict_pairs(m, r).orderBy("user_id", "item_id").select("pred").collect()
    b = M.predict_pairs(m2, r).orderBy("user_id", "item_id").select("pred").collect()
    assert a == b


def test_intake_stream_equals_batch(spark, tmp_dir):
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(30) for i in range(12) if (u + i) % 3]
    src = spark.createDataFrame(rows, "user_id long, item_id int, rating double")
    src.repartition(5, "user_id").write.parquet(f"{tmp_dir}/in")
    q = item_stats_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck", files_per_batch=1)
    q.awaitTermination()
    assert q.lastProgress is not None
    got = {r["item_id"]: (r["n"], r["mean"]) for r in read_stats(spark, f"{tmp_dir}/out").collect()}
    want = {r["item_id"]: (r["n"], round(r["m"], 6))
            for r in src.groupBy("item_id").agg(F.count("*").alias("n"), F.avg("rating").alias("m")).collect()}
    assert got == want


def _latest(rows):
    best = {}
    for u, i, r, at in rows:
        if None not in (u, i, r, at):
            best[u, i] = max(best.get((u, i), (at, r)), (at, r))
    return best


def test_latest_rating_wins_over_restarts_and_compaction(spark, tmp_dir):
    rnd = random.Random(2)
    rows = [(rnd.randint(0, 9), rnd.randint(0, 5), float(rnd.randint(1, 5)), n) for n in range(300)]
    rows += [(1, 1, None, 999), (None, 1, 3.0, 999), (2, 2, 4.0, 7), (2, 2, 4.0, 7)]
    rnd.shuffle(rows)  # late files hold older ratings, too
    seen = []
    for start in (0, 150):  # the query ends and is started anew on its checkpoint
        for n in range(start, min(start + 150, len(rows)) if not start else len(rows), 30):
            part = rows[n:n + 30] if n + 30 <= start + 150 or start else rows[n:start + 150]
            seen += part
            spark.createDataFrame(part, IN.TIMED_SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        q = IN.latest_ratings_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck", compact_every=3,
                                     state_partitions=2)
        q.awaitTermination()
        best = _latest(seen)
        got = {r.item_id: (r.n, r.total) for r in IN.read_latest_stats(spark, f"{tmp_dir}/out").collect()}
        assert got == {i: (sum(k[1] == i for k in best), sum(v[1] for k, v in best.items() if k[1] == i)) for _, i in best}
    assert sorted(seen, key=str) == sorted(rows, key=str)
    totals, epochs = IN._published(spark, f"{tmp_dir}/out")
    assert len(totals) == 1 and len(epochs) <= 4
    before = sorted(map(tuple, IN.read_latest_stats(spark, f"{tmp_dir}/out").collect()))
    IN.compact(spark, f"{tmp_dir}/out", max(epochs))
    IN.compact(spark, f"{tmp_dir}/out", max(epochs))  # again, as after a failure
    assert sorted(map(tuple, IN.read_latest_stats(spark, f"{tmp_dir}/out").collect())) == before
    state = {(r.user_id, r.item_id): r.rating for r in IN.ratings_in_state(spark, f"{tmp_dir}/ck").collect()}
    assert state == {k: v[1] for k, v in best.items()}
    assert M.fit_als(IN.ratings_in_state(spark, f"{tmp_dir}/ck"), rank=2, iters=2).users.count() == 10


def test_latest_ratings_state_holds_cells_of_pairs(spark, tmp_dir):
    """Python is called once per state row and batch: many pairs share one."""
    rows = [(u, i, float((u + i + n) % 5 + 1), 1000 * n + u + 8) for n in range(2) for u in range(-8, 24) for i in range(0, 300, 5)]
    src = spark.createDataFrame(rows, IN.TIMED_SCHEMA).coalesce(1)
    for n in range(2):
        src.filter(f"at div 1000 = {n}").write.mode("append").parquet(f"{tmp_dir}/in")
    IN.latest_ratings_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck", state_partitions=2).awaitTermination()
    best = _latest(rows)
    assert spark.read.format("statestore").load(f"{tmp_dir}/ck").count() <= len(best) / 100
    state = {(r.user_id, r.item_id): r.rating for r in IN.ratings_in_state(spark, f"{tmp_dir}/ck").collect()}
    assert state == {k: v[1] for k, v in best.items()}
    got = {r.item_id: (r.n, r.total) for r in IN.read_latest_stats(spark, f"{tmp_dir}/out").collect()}
    assert got == {i: (32, sum(v[1] for k, v in best.items() if k[1] == i)) for i in range(0, 300, 5)}
