"""Continuous intake of ratings.

New rating files land in a folder; a Structured Streaming query reads them
with a declared schema, keeps the running count and sum per item in the
state store (checkpointed, so a restarted or re-tried query resumes exactly
once), and after every micro-batch writes the statistics that changed. The
latest-wins replacement of a user's earlier rating is a batch operation
(``kiln.operators.clean.append_latest``); the stream counts arrivals.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kiln.session import folder_names, remove, ship_package

RATING_SCHEMA = "user_id long, item_id int, rating double"
TIMED_SCHEMA = RATING_SCHEMA + ", at long"
DELTA_SCHEMA = "item_id int, n long, total double"
STATE_SCHEMA = "user array<long>, item array<int>, at array<long>, rating array<double>"
USER_BITS, ITEM_BITS = 4, 8  # a state row is a cell of 2**USER_BITS user ids and 2**ITEM_BITS item ids


def item_stats_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                      files_per_batch: int = 1, available_now: bool = True,
                      state_partitions: int | None = None) -> StreamingQuery:
    """Start the intake query: files in ``in_dir`` -> per-item count, sum and
    mean in ``out_dir``, update mode: each micro-batch writes only the items it
    changed, to a folder of its epoch. A batch that is run again replaces its
    own folder, and readers always see whole epochs.

    ``state_partitions`` sizes the state store (fixed in the checkpoint at the
    first start); the query runs in a session of its own, so the caller's
    settings stay as they are."""
    own = spark.newSession()
    if state_partitions is not None:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    src = (own.readStream.schema(RATING_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
           .parquet(in_dir))
    stats = src.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total"))

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/epoch={epoch}")

    w = (stats.writeStream.outputMode("update").foreachBatch(publish)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def read_stats(spark: SparkSession, out_dir: str, digits: int = 6) -> DataFrame:
    """The latest statistics of each item."""
    s = spark.read.schema("item_id int, n long, total double, epoch long").parquet(out_dir)
    now = s.groupBy("item_id").agg(F.max_by(F.struct("n", "total"), "epoch").alias("s")).select("item_id", "s.*")
    return now.select("item_id", "n", F.round("total", digits).alias("total"),
                      F.round(F.col("total") / F.col("n"), digits).alias("mean"))


def _replace_ratings(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The latest ratings of a cell of users and items and what they change in
    the items' sums: each new value less the one it replaces."""
    old = {(u, i): (at, r) for u, i, at, r in zip(*state.get)} if state.exists else {}
    new = {}
    for p in parts:
        for u, i, at, r in zip(*(p[c].tolist() for c in ("user_id", "item_id", "at", "rating"))):
            best = new.get((u, i)) or old.get((u, i))
            if best is None or (at, r) > best:
                new[u, i] = at, r
    if not new:
        return
    state.update(tuple(map(list, zip(*((*pair, *best) for pair, best in (old | new).items())))))
    changes = {}
    for pair, (_, r) in new.items():
        n, total = changes.get(pair[1], (0, 0.0))
        changes[pair[1]] = n + (pair not in old), total + r - (old[pair][1] if pair in old else 0.0)
    yield pd.DataFrame({"item_id": list(changes), "n": [n for n, _ in changes.values()], "total": [t for _, t in changes.values()]})


def latest_ratings_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, files_per_batch: int = 1,
                          available_now: bool = True, state_partitions: int | None = None,
                          compact_every: int = 16) -> StreamingQuery:
    """Start the latest-wins intake: files of (user, item, rating, at) -> per
    item the count and sum of the latest rating of each of its users (the
    largest ``at``; of equal ones the larger rating), whatever the order in
    which files arrive. Rows with a null are left out. The state has a row per
    cell of neighbouring user and item ids, at most 4,096 ratings, so Python is
    called once per cell and batch, not once per pair, and no row grows on.

    Each micro-batch writes the changes of its items to ``deltas/epoch=E``; a
    batch that is run again replaces its own folder. Every ``compact_every``
    batches the changes of all earlier, committed batches are added up in
    ``totals/upto=E`` and their folders deleted, so a reader meets at most
    2 x ``compact_every`` folders."""
    own = spark.newSession()
    ship_package(own)
    if state_partitions is not None:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    src = own.readStream.schema(TIMED_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(in_dir)
    cell = {"_users": F.shiftright("user_id", USER_BITS), "_items": F.shiftright("item_id", ITEM_BITS)}
    deltas = src.dropna().withColumns(cell).groupBy(*cell).applyInPandasWithState(
        _replace_ratings, DELTA_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout)

    def publish(batch: DataFrame, epoch: int) -> None:
        sums = batch.groupBy("item_id").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        sums.write.mode("overwrite").parquet(f"{out_dir}/deltas/epoch={epoch}")
        if epoch and epoch % compact_every == 0:
            compact(own, out_dir, epoch - 1)

    w = deltas.writeStream.outputMode("update").foreachBatch(publish).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def _published(spark: SparkSession, out_dir: str) -> tuple[list[int], list[int]]:
    """Complete totals and the epochs of changes, ascending."""
    numbers = lambda folder, whole: sorted(int(n.partition("=")[2]) for n in folder_names(spark, folder, whole))
    return numbers(f"{out_dir}/totals", "_SUCCESS"), numbers(f"{out_dir}/deltas", "_SUCCESS")


def compact(spark: SparkSession, out_dir: str, upto: int) -> None:
    """Add up all changes up to epoch ``upto`` and delete what that replaces.
    Done again after a failure it finishes what is left to do."""
    totals, epochs = _published(spark, out_dir)
    if upto not in totals:
        parts = [f"{out_dir}/totals/upto={t}" for t in totals[-1:]] + [
            f"{out_dir}/deltas/epoch={e}" for e in epochs if (totals[-1] if totals else -1) < e <= upto]
        if not parts:
            return
        _sums(spark, parts).write.mode("overwrite").parquet(f"{out_dir}/totals/upto={upto}")
    remove(spark, *[f"{out_dir}/totals/upto={t}" for t in totals if t < upto],
           *[f"{out_dir}/deltas/epoch={e}" for e in epochs if e <= upto])


def _sums(spark: SparkSession, parts: list[str]) -> DataFrame:
    return (spark.read.schema(DELTA_SCHEMA).parquet(*parts).groupBy("item_id")
            .agg(F.sum("n").alias("n"), F.sum("total").alias("total")))


def read_latest_stats(spark: SparkSession, out_dir: str, digits: int = 6) -> DataFrame:
    """Count, sum and mean of the latest ratings of each item, as published."""
    totals, epochs = _published(spark, out_dir)
    parts = [f"{out_dir}/totals/upto={t}" for t in totals[-1:]] + [
        f"{out_dir}/deltas/epoch={e}" for e in epochs if e > (totals[-1] if totals else -1)]
    s = _sums(spark, parts) if parts else spark.createDataFrame([], DELTA_SCHEMA)
    return s.select("item_id", "n", F.round("total", digits).alias("total"),
                    F.round(F.col("total") / F.col("n"), digits).alias("mean"))


def ratings_in_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(user_id, item_id, rating): the latest ratings that the stream's state
    holds, for a refit on demand, read from its checkpoint as a table."""
    s = spark.read.format("statestore").load(checkpoint)
    held = F.explode(F.arrays_zip(*(f"value.groupState.{c}" for c in ("user", "item", "rating"))))
    return s.select(held.alias("r")).select(F.col("r.user").alias("user_id"), F.col("r.item").alias("item_id"), "r.rating")
