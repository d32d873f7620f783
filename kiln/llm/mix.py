"""Mixing sources to target weights with a low-discrepancy schedule.

1. Sizes: words per document, summed per source. Targets share the total by
   weight and stop at ``MAX_REPEAT`` times a source's size; the excess goes to
   the others by weight.
2. Blocks: each source's documents stand in a shuffled order (a hash of id and
   text) and are read round and round; its words are cut into blocks of
   ``block`` words.
3. Schedule: slot i has the point ``frac(i * golden ratio)``, which falls into
   one source's stretch of the cumulative target shares. The k-th slot of a
   source takes that source's k-th block, so every prefix of the schedule has
   the mix near its targets. Blocks of a source beyond its target are not
   taken, the last one is cut at the target; a source whose slots run out
   before its target gets its last blocks at the end of the schedule.
4. Order: a document stands at the first slot that takes words of it.
   ``mixed_documents`` leaves its rows in that order, from part to part and
   within each, so that what reads them in order meets the mix near its
   targets in every prefix.

Nothing but words is counted per source in one place: the shuffled order is
dealt in buckets of the hash, whose sums give each bucket its start, and slots
are ranked in runs of ``RUN`` in the same way. A source with a third of all
rows is thus many buckets, runs and blocks. The table of sources has one row
per source; it is the only thing that is ordered in one window.

Defined results: a null text has no words and takes none; a null source is a
source of its own, last in order; rows with equal id, source and text stand
next to each other in the order and are told apart by a row number; an empty
table gives an empty mix; other columns are carried by ``mixed_documents``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import fresh, word_array, word_count, work_dir, written

MAX_REPEAT = 3
SLOTS = 1 << 17
MAX_BLOCK = 4096
RUN = 1 << 14
CELLS = 4096
# Slot points: i * GOLDEN mod MODULUS, near the golden ratio's multiples; the product fits a long.
MODULUS = 2147483647
GOLDEN = round(MODULUS * (math.sqrt(5) - 1) / 2)


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Narrow table (id, source, size, h, row), fixed once: h is the shuffled
    order, row tells rows apart."""
    text = F.col(text_col)
    slim = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text).alias("size"),
                       F.xxhash64(F.col(id_col), text, F.col(source_col)).alias("h"))
    return written(slim.withColumn("row", F.monotonically_increasing_id()), work_dir(docs.sparkSession, "sized"))


def targets(docs: DataFrame, weights: Sequence[float] = (1, 2, 3)) -> DataFrame:
    """Per source: source_size, weight, target, words (target as whole words).

    Water level: with sources in ascending order of cap / weight, the first
    ones are capped as long as the level of what then remains, spread over the
    remaining weight, lies above their cap / weight."""
    per = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    choices = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.element_at(choices, F.pmod(F.row_number().over(by_name) - 1, len(weights)) + 1))
    per = per.withColumn("cap", F.col("source_size") * MAX_REPEAT)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, behind = (by_ratio.rowsBetween(Window.unboundedPreceding, -1),
                      by_ratio.rowsBetween(0, Window.unboundedFollowing))
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) \
        / F.sum("weight").over(behind)
    per = per.withColumn("level", level).withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    first_free = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)
    per = per.withColumn("free", first_free)
    target = F.when(F.col("capped") | F.col("free").isNull(), F.col("cap").cast("double")) \
        .otherwise(F.col("free.level") * F.col("weight"))
    return (per.withColumn("target", target)
            .withColumn("words", F.least(F.floor(F.col("target") + 0.5), F.col("cap")).cast("long"))
            .select("source", "source_size", "weight", "target", "words"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _placed(docs: DataFrame, per: DataFrame, rows: int) -> DataFrame:
    """``docs`` with its source's figures and ``pos``: words of its source
    before it in shuffled order. The figures travel with the bucket sums, so a
    hot source is joined bucket by bucket."""
    bits = max(rows // 4096, 1).bit_length()
    docs = docs.withColumn("bucket", F.shiftrightunsigned("h", 64 - bits))
    sums = docs.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    w = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))
    p = per.select(F.col("source").alias("ps"), "source_size", "target", "words")
    sums = written(sums.join(p, _same(sums.source, p.ps)).select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), "before", "source_size", "target", "words"),
        work_dir(docs.sparkSession, "bucket-sums"))
    docs = docs.join(sums, _same(docs.source, sums.s) & (docs.bucket == sums.b)).drop("s", "b")
    within = (Window.partitionBy("source", "bucket").orderBy("h", "id", "row")
              .rowsBetween(Window.unboundedPreceding, -1))
    return (docs.withColumn("pos", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
            .drop("before", "bucket"))


def schedule(per_source: DataFrame, block: int, total: int) -> DataFrame:
    """(slot, source, block_no): which source's which block each slot takes."""
    spark = per_source.sparkSession
    share = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    s = (per_source.filter("words > 0").withColumn("hi", F.sum("target").over(share) / F.lit(float(max(total, 1))))
         .withColumn("lo", F.col("hi") - F.col("target") / F.lit(float(max(total, 1))))
         .withColumn("blocks", F.ceil(F.col("words") / block).cast("long")))
    cells = F.explode(F.sequence(F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1))))
    ranges = s.select("source", "lo", "hi", "blocks", cells.alias("cell"))
    n = -(-total // block) if total else 0
    point = F.pmod(F.col("id") + 1, F.lit(MODULUS)) * F.lit(GOLDEN) % F.lit(MODULUS) / F.lit(float(MODULUS))
    slots = (spark.range(0, n + 64).select(F.col("id").alias("slot"), point.alias("u"))
             .withColumn("cell", F.floor(F.col("u") * CELLS)))
    met = (slots.join(ranges, "cell").filter("u >= lo AND u < hi")
           .select("slot", "source", "blocks", F.floor(F.col("slot") / RUN).alias("run")))
    runs = met.groupBy("source", "run").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("source").alias("s"), F.col("run").alias("r"),
                       F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    in_run = Window.partitionBy("source", "run").orderBy("slot")
    ranked = (met.join(runs, _same(met.source, runs.s) & (met.run == runs.r))
              .withColumn("block_no", F.col("before") + F.row_number().over(in_run) - 1)
              .filter(F.col("block_no") < F.col("blocks")).select("slot", "source", "block_no"))
    # a source that met too few slots takes its last blocks behind all others
    have = ranked.groupBy("source").agg(F.count(F.lit(1)).alias("have"))
    have = have.select(F.col("source").alias("s"), "have")
    late = (s.join(have, _same(s.source, have.s), "left").withColumn("have", F.coalesce("have", F.lit(0)))
            .filter(F.col("have") < F.col("blocks"))
            .select("source", F.explode(F.sequence(F.col("have"), F.col("blocks") - 1)).alias("block_no"))
            .select((F.col("block_no") + n + 64).alias("slot"), "source", "block_no"))
    return ranked.unionByName(late)


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(documents, pieces). documents: row, id, source, h, size, source_size,
    target for every row; pieces: slot, row, turn (which reading of the
    source), first_word, n_words -- the words that each slot takes, in order."""
    spark = docs.sparkSession
    slim = sized(docs, id_col, text_col, source_col)
    rows, total = slim.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    per = written(targets(slim, weights), work_dir(spark, "targets"))
    block = min(max(total // SLOTS, 1), MAX_BLOCK)
    placed = written(_placed(slim, per, rows), work_dir(spark, "placed"))
    # stretches of each reading that lie before the source's cut
    turns = placed.filter("size > 0").withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(MAX_REPEAT - 1))))
    turns = turns.withColumn("from", F.col("turn") * F.col("source_size") + F.col("pos"))
    turns = turns.withColumn("to", F.least(F.col("from") + F.col("size"), F.col("words"))).filter("to > from")
    cut = turns.withColumn("block_no", F.explode(F.sequence(F.floor(F.col("from") / block),
                                                            F.floor((F.col("to") - 1) / block))))
    lo = F.greatest(F.col("from"), F.col("block_no") * block)
    hi = F.least(F.col("to"), (F.col("block_no") + 1) * block)
    cut = cut.select("row", "source", "turn", "block_no", (lo - F.col("from")).alias("first_word"),
                     (hi - lo).alias("n_words"))
    slots = written(schedule(per, block, total), work_dir(spark, "slots")).select("slot", F.col("source").alias("s"), F.col("block_no").alias("b"))
    pieces = cut.join(slots, _same(cut.source, slots.s) & (cut.block_no == slots.b)).drop("s", "b", "block_no", "source")
    documents = placed.select("row", "id", "source", "h", "size", "source_size", "target")
    return documents, pieces


def taken(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source") -> DataFrame:
    """Per row of ``docs``: id, size, source_size, target of its source,
    taken, the words that the mix takes from it, and first_slot, where in the
    schedule it takes the first of them (null: none)."""
    documents, pieces = mix(docs, weights, id_col, text_col, source_col)
    sums = pieces.groupBy("row").agg(F.sum("n_words").alias("taken"), F.min("slot").alias("first_slot"))
    return documents.join(sums, "row", "left").select(
        F.col("id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"),
        "first_slot")


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source", chars_col: str | None = "n_chars") -> DataFrame:
    """The mix as documents with all columns of ``docs``: a row for each
    reading of a document, whole, or cut behind the last word that is taken
    (words then joined by one space, ``chars_col`` counted anew). Rows stand
    in the order of their first slots; slots hold equal numbers of words, so
    the parts are stretches of slots of equal width."""
    documents, pieces = mix(docs, weights, id_col, text_col, source_col)
    spark = docs.sparkSession
    h, at, reads, take, list_id, list_h, slot = fresh(docs, "h", "at", "reads", "take", "ati", "ath", "slot")
    per_turn = pieces.groupBy("row", "turn").agg(F.sum("n_words").alias("words"), F.min("slot").alias("slot"))
    per_row = per_turn.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("turn", "words", "slot"))).alias("turns"))
    # rows with equal id, source and text stand in one list and take its entries in turn
    lists = (documents.join(per_row, "row").groupBy("id", "h")
             .agg(F.sort_array(F.collect_list(F.struct("row", "turns", "size"))).alias(reads))
             .select(F.col("id").alias(list_id), F.col("h").alias(list_h), reads))
    lists = written(lists, work_dir(spark, "readings"))
    slots = F.flatten(F.transform(reads, lambda r: r["turns"]["slot"]))
    last = lists.agg(F.coalesce(F.max(F.array_max(slots)), F.lit(0))).first()[0]
    d = docs.withColumn(h, F.xxhash64(F.col(id_col), F.col(text_col), F.col(source_col)))
    d = d.join(lists, _same(d[id_col], lists[list_id]) & (d[h] == lists[list_h]))
    nth = Window.partitionBy(list_h, list_id).orderBy(h)
    d = d.withColumn(at, F.row_number().over(nth)).withColumn(reads, F.get(reads, F.col(at) - 1))
    d = d.withColumn(take, F.explode(F.col(f"{reads}.turns")))
    cut = F.col(f"{take}.words") < F.col(f"{reads}.size")
    text = F.when(cut, F.array_join(F.slice(word_array(F.col(text_col)), F.lit(1), F.col(f"{take}.words").cast("int")), " ")) \
        .otherwise(F.col(text_col))
    columns = {text_col: text.alias(text_col)}
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        columns[chars_col] = F.when(cut, F.length(text).cast(kind)).otherwise(F.col(chars_col)).alias(chars_col)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = d.select(*[columns.get(c, F.col(c)) for c in docs.columns], F.col(f"{take}.slot").alias(slot))
    part = F.floor(F.col(slot) * parts / F.lit(last + 1)).cast("int")
    return d.repartitionById(parts, part).sortWithinPartitions(slot).drop(slot)
