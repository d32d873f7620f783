"""Exact running totals without a single-partition window.

A ``Window`` without ``partitionBy`` moves every row into one task. Instead:

1. a mergeable sketch of the order values, about ``SKETCH`` entries per bucket:
   the quantile summary that Spark keeps for one numeric or time column; for
   other orders the values whose hash falls below a share of the hash range.
   Its evenly spaced quantiles bound the buckets;
2. every row finds its bucket by binary search in the bounds;
3. totals per (bucket, key) -- at most #buckets x #keys rows -- turn into
   offsets by a window over that small table;
4. the offsets are joined back and a window per (bucket, key), each about one
   bucket of rows, finishes the sums. Ranks asked for (quantiles) narrow the
   rows down to the buckets that hold them before that shuffle.

Bounds and counts are scalar subqueries: everything is one lazy plan, and
building it runs no job, writes nothing and keeps nothing. The bounds are
found once per query, so all its tasks, also recomputed ones, deal a value to
the same bucket. The result is exact whatever the bounds. ``order`` should be unique within ``keys`` (callers
aggregate to distinct values first); rows with equal order values are in one
bucket and get consecutive positions in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

PID = "_range_pid"
SKETCH = 64  # members of the sketch per bucket


def _doublings(df: DataFrame, parts: int | None) -> int:
    """Log2 of the number of buckets: that of shuffle partitions, rounded up."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(parts - 1, 1).bit_length()


def bucketed(df: DataFrame, order: Sequence[Column | str], keys: Sequence[str] = (),
             parts: int | None = None) -> tuple[DataFrame, list[str]]:
    """``df`` with its bucket ``_range_pid`` in the ascending order of (keys,
    order), and the names of the order columns added."""
    names = [f"_order{i}" for i in range(len(order))]
    rows = df.withColumns({n: F.col(o) if isinstance(o, str) else o for n, o in zip(names, order)})
    k = _doublings(df, parts)
    kind = rows.schema[names[0]].dataType
    if len(names) == 1 and not keys and isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType)):
        place = F.col(names[0])
        shares = F.array(*[F.lit(i / (1 << k)) for i in range(1, 1 << k)])
        bounds = rows.agg(F.percentile_approx(names[0], shares, F.lit(SKETCH << k)).alias("b")).select("b").scalar()
    else:
        place = F.struct(*keys, *names)
        members = rows.select(place.alias("m"))
        count = F.greatest(F.count(F.lit(1)), F.lit(1))
        share = members.agg((F.lit(float(SKETCH << k)) * 2.0**32 / count).alias("s")).select("s").scalar()
        sketch = members.filter(F.pmod(F.xxhash64("m"), F.lit(1 << 32)) < share).agg(F.sort_array(F.collect_list("m")).alias("m"))
        bounds = sketch.select(F.transform(F.sequence(F.lit(1), F.lit((1 << k) - 1)), lambda i: F.get(
            "m", F.floor(i * F.size("m") / F.lit(1 << k)).cast("int"))).alias("b")).select("b").scalar()
    rows = rows.withColumn(PID, F.lit(0))
    for step in (1 << i for i in range(k - 1, -1, -1)):  # how many bounds are at most the row's place
        rows = rows.withColumn(PID, F.col(PID) + F.when(F.get(bounds, F.col(PID) + step - 1) <= place, step).otherwise(0))
    return rows, names


def offsets(rows: DataFrame, sums: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Per bucket and key: ``_off_<s>``, the sum of ``s`` in the buckets before,
    and ``_pt_<s>``, that of the bucket itself."""
    part = rows.groupBy(PID, *keys).agg(*[F.sum(s).alias(f"_pt_{s}") for s in sums])
    before = Window.partitionBy(*keys).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    return part.select(PID, *keys, *[f"_pt_{s}" for s in sums], *[
        F.coalesce(F.sum(f"_pt_{s}").over(before), F.lit(0)).alias(f"_off_{s}") for s in sums])


def _finished(rows: DataFrame, names: Sequence[str], off: DataFrame, columns: Sequence[str], sums: Sequence[str],
              keys: Sequence[str], prefix: str) -> DataFrame:
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in [PID, *keys]]
    joined = rows.alias("r").join(off.alias("o"), same).select("r.*", *[f"o._off_{s}" for s in sums])
    local = Window.partitionBy(PID, *keys).orderBy(*names).rowsBetween(Window.unboundedPreceding, 0)
    return joined.select(*columns, *[(F.col(f"_off_{s}") + F.sum(s).over(local)).alias(f"{prefix}{s}") for s in sums])


def running_sum(df: DataFrame, order: Sequence[Column | str], sums: Sequence[str],
                keys: Sequence[str] = (), parts: int | None = None, prefix: str = "cum_",
                many_keys: bool = False) -> DataFrame:
    """Add ``cum_<s>`` = sum of ``s`` over rows up to and including this one,
    in ascending ``order`` within ``keys`` (negate a number to go down). Few
    keys share the buckets of their values; with ``many_keys`` buckets follow
    (keys, order), so that a small key lies in one or two of them."""
    rows, names = bucketed(df, order, keys if many_keys else (), parts)
    return _finished(rows, names, offsets(rows, sums, keys), df.columns, sums, keys, prefix)


def rows_at(df: DataFrame, order: Sequence[Column | str], count: str, positions: DataFrame,
            keys: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """Rows of those buckets that hold a position asked for, with
    ``cum_<count>``. ``positions`` has the keys and ``_at``, an array of
    0-based positions, per key."""
    rows, names = bucketed(df, order, parts=parts)
    off = offsets(rows, [count], keys)
    asked = off.join(positions, list(keys)) if keys else off.withColumn("_at", positions.select("_at").scalar())
    inside = F.exists("_at", lambda p: (p >= F.col(f"_off_{count}")) & (p < F.col(f"_off_{count}") + F.col(f"_pt_{count}")))
    return _finished(rows, names, asked.filter(inside), df.columns, [count], keys, "cum_")


def dense_index(df: DataFrame, column: str, name: str | None = None, parts: int | None = None) -> DataFrame:
    """distinct values of ``column`` numbered 0..n-1 in ascending
    order -- deterministic, distributed, no driver-side dictionary."""
    d = df.select(column).filter(F.col(column).isNotNull()).distinct().withColumn("_one", F.lit(1))
    r = running_sum(d, [column], ["_one"], parts=parts)
    return r.select(column, (F.col("cum__one") - 1).cast("long").alias(name or f"{column}_idx"))
