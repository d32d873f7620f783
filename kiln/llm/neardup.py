"""Near-dedup: BagMinHash signatures, bands, and exact overlap of bags.

A document is the bag (multiset) of its 5-word shingles; two texts are linked
if the weighted Jaccard similarity of their bags is at least 0.8. Classes are
the connected components of links; equal texts are one class from the start.

1. One pass over the texts gives ``BANDS`` band keys of ``ROWS`` BagMinHash
   slots each. At a similarity of 0.8 two texts share no band with a chance of
   3e-6. Texts that share a band stand in one bucket.
2. First each member of a bucket is compared with one text of it (a different
   choice in every band): a few comparisons per text, which join almost all of
   a large group of near copies.
3. In buckets that still hold several components the members outside the
   largest one are compared with all others, in groups of at most ``GROUP`` of
   each, a group in one task: members come with their bags and a finer
   signature of ``FINE`` slots, pairs of different components are taken in
   order of estimated similarity, and a pair is left out as soon as its
   components have met. Estimates five deviations below the threshold need no
   look at the bags. So pairs never become rows.
4. Buckets with more than ``LARGE`` members outside the largest component
   would make too many groups at once. Their members are dealt anew, without a
   loss: by the rarest shingles of each bag, so many that two bags of the
   threshold have one of them in common (prefix filter). This parts texts that
   only share a common line or passage. All buckets of this second deal are
   worked off as in 3, whatever their size.
5. Every link is verified by the overlap of the two whole bags.

Bags of the candidates are written once; a text compared with very many others
meets them through ``join_hot``. Links and components stay on the cluster.

Defined results: a null or empty text has no shingles and equals other empty
texts only; a text of fewer than 5 words is one shingle; rows that repeat id and
text are one document; a null id never names a class that has another id; an
empty table gives no rows; other columns are carried by ``near_dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm import bagminhash as B
from kiln.llm import words as W
from kiln.llm.common import fresh, join_hot, prepare, work_dir, written
from kiln.llm.components import components
from kiln.llm.substring import text_key

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
GROUP, LARGE, FINE = 256, 1 << 14, 1024
SLICE_BYTES = 2 << 20


def _slices(column) -> Iterator[tuple[int, int]]:
    _, offsets = W.utf8(column)
    lo = 0
    while lo < len(column):
        hi = max(int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, side="right")) - 1, lo + 1)
        yield lo, hi
        lo = hi


def _signatures(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in _slices(b.column("text")):
                part = b.slice(lo, hi - lo)
                _, _, _, h, first = W.words(part.column("text"))
                bag, element, weight = B.bags(h, first, shingle)
                n = part.num_rows
                sig = B.signatures(bag, element, weight, n, BANDS * ROWS).reshape(n, BANDS, ROWS)
                key = np.zeros((n, BANDS), np.uint64)
                for i in range(ROWS):
                    key = W.mix(key * np.uint64(0xD6E8FEB86659FD93) + sig[:, :, i])
                key = W.mix(key + np.arange(BANDS, dtype=np.uint64))
                size = np.bincount(bag, weights=weight, minlength=n).astype(np.int64)
                ends = np.arange(n + 1, dtype=np.int32) * BANDS
                yield pa.RecordBatch.from_pydict({
                    "id": part.column("id"), "digest": part.column("digest"), "size": pa.array(size),
                    "bands": pa.ListArray.from_arrays(pa.array(ends), pa.array(key.ravel().view(np.int64)))})
    return run


def _bags(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in _slices(b.column("text")):
                part = b.slice(lo, hi - lo)
                _, _, _, h, first = W.words(part.column("text"))
                bag, element, weight = B.bags(h, first, shingle)
                at = np.searchsorted(bag, np.arange(part.num_rows + 1))
                fine = B.signatures(bag, element, weight, part.num_rows, FINE).astype(np.uint8)
                yield pa.RecordBatch.from_pydict({
                    "rid": part.column("rid"),
                    "shingles": pa.array([element[a:z].astype("<u8").tobytes() for a, z in zip(at, at[1:])], pa.binary()),
                    "counts": pa.array([weight[a:z].astype("<u4").tobytes() for a, z in zip(at, at[1:])], pa.binary()),
                    "fine": pa.array([x.tobytes() for x in fine], pa.binary())})
    return run


def similarity(x: bytes, nx: bytes, y: bytes, ny: bytes) -> float:
    """Weighted Jaccard similarity of two bags with sorted elements."""
    a, b = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
    n, m = np.frombuffer(nx, "<u4").astype(np.int64), np.frombuffer(ny, "<u4").astype(np.int64)
    if not len(a) or not len(b):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = np.minimum(n, m[at])[b[at] == a].sum()
    return float(both / (n.sum() + m.sum() - both))


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bag as a set: one token for each copy of a shingle."""
    for b in batches:
        for rid, size, x, nx in zip(*[b.column(c).to_pylist() for c in ("rid", "size", "shingles", "counts")]):
            n = np.frombuffer(nx, "<u4").astype(np.int64)
            copy = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            token = W.mix(np.repeat(np.frombuffer(x, "<u8"), n) + copy.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            yield pa.RecordBatch.from_pydict({"rid": pa.array(np.full(len(token), rid, np.int64)),
                                              "size": pa.array(np.full(len(token), size, np.int64)),
                                              "token": pa.array(token.view(np.int64))})


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("s1", "n1", "s2", "n2")]
        sim = [similarity(*x) for x in zip(*cols)]
        yield pa.RecordBatch.from_pydict({"a": b.column("a"), "b": b.column("b"), "sim": pa.array(sim, pa.float64())})


def _group(threshold: float):
    """Links between a group's outer members (its ``left`` rows, or the
    ``out`` rows where it has none) and its other rows."""
    cut = threshold - 5 * (threshold * (1 - threshold) / FINE) ** 0.5

    def run(t: pa.Table) -> pa.Table:
        rid, comp = t["rid"].to_numpy(), t["comp"].to_numpy()
        bag = list(zip(t["shingles"].to_pylist(), t["counts"].to_pylist()))
        fine = np.stack([np.frombuffer(x, np.uint8) for x in t["fine"].to_pylist()])
        left = t["left"].to_numpy()
        right = np.flatnonzero(~left)
        outer = np.flatnonzero(left) if left.any() else np.flatnonzero(t["out"].to_numpy())
        root = {c: c for c in comp.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        found = []
        for i in outer.tolist():
            est = (fine[i] == fine[right]).mean(axis=1)
            found += [(-est[j], i, int(right[j])) for j in np.flatnonzero((est >= cut) & (comp[right] != comp[i]))]
        links = []
        for _, i, j in sorted(found):
            a, b = find(int(comp[i])), find(int(comp[j]))
            if a == b:
                continue
            sim = similarity(*bag[i], *bag[j])
            if sim >= threshold:
                root[max(a, b)] = min(a, b)
                links.append((int(min(rid[i], rid[j])), int(max(rid[i], rid[j])), sim))
        return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64()),
                         "sim": pa.array([x[2] for x in links], pa.float64())})
    return run


_LINK = "a long, b long, sim double"


class _Search:
    """Links among bucket members; each round works on what is unfinished."""

    def __init__(self, nodes: DataFrame, bags: DataFrame, threshold: float):
        self.spark, self.bags, self.threshold = nodes.sparkSession, bags, threshold
        self.links: DataFrame | None = None
        self.labels: DataFrame | None = None

    def add(self, links: DataFrame) -> None:
        """New links extend the components."""
        links = written(links, work_dir(self.spark, "links"))
        if not links.isEmpty():
            self.links = links if self.links is None else self.links.unionByName(links)
            self.labels = components(self.links, self.labels)

    def first_links(self, members: DataFrame) -> DataFrame:
        """Each member of a bucket with one text of it, verified. Only the
        texts chosen for a bucket may stand in very many pairs; the sizes of
        two bags bound their similarity."""
        first = members.groupBy("bucket").agg(F.min_by(F.struct("rid", "size"), F.xxhash64("bucket", "rid")).alias("r"))
        first = first.select("bucket", F.col("r.rid").alias("rep"), F.col("r.size").alias("size1"))
        pairs = join_hot(members, first, ["bucket"]).filter(
            (F.col("rid") != F.col("rep")) & (F.least("size", "size1") >= self.threshold * F.greatest("size", "size1")))
        pairs = pairs.groupBy(F.least("rep", "rid").alias("a"), F.greatest("rep", "rid").alias("b")).agg(
            F.max(F.struct("rep", "rid")).alias("p"))
        pairs = written(pairs.select("a", "b", "p.rep", "p.rid"), work_dir(self.spark, "pairs"))
        b1 = self.bags.select(F.col("rid").alias("rep"), F.col("shingles").alias("s1"), F.col("counts").alias("n1"))
        b2 = self.bags.select("rid", F.col("shingles").alias("s2"), F.col("counts").alias("n2"))
        met = join_hot(pairs, b1, ["rep"]).join(b2, "rid").select("a", "b", "s1", "n1", "s2", "n2")
        return met.mapInArrow(_verify, _LINK).filter(F.col("sim") >= self.threshold)

    def unfinished(self, members: DataFrame) -> DataFrame:
        """Members, with component, of buckets of several components; of
        buckets with the same members one stays. ``out`` tells who stands
        outside the largest component."""
        now = members.withColumn("comp", F.col("rid")) if self.labels is None else (
            members.join(self.labels.withColumnRenamed("node", "rid"), "rid", "left")
            .withColumn("comp", F.coalesce("comp", "rid")))
        now = written(now, work_dir(self.spark, "members"))
        parts = now.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("rid")).alias("who"))
        state = parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("top"),
                                            F.bit_xor("who").alias("who"))
        state = state.filter("top.n < n").groupBy("n", "who").agg(F.min(F.struct("bucket", "top")).alias("s"))
        state = state.select("s.bucket", "n", F.col("s.top.comp").alias("largest"), (F.col("n") - F.col("s.top.n")).alias("o"))
        met = join_hot(now, state, ["bucket"]).withColumn("out", F.col("comp") != F.col("largest")).drop("largest")
        return written(met, work_dir(self.spark, "open"))

    def grouped(self, open_: DataFrame) -> DataFrame:
        """Rows of the groups: outer members by blocks, with all members by
        blocks; a bucket of one block each has its rows once."""
        blocks = lambda c: F.ceil(F.col(c) / GROUP)
        all_of = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), blocks(c) - 1))
        h = F.xxhash64("rid")
        right = (open_.withColumn("mb", F.pmod(h, blocks("n"))).withColumn("ob", all_of("o"))
                 .withColumn("left", F.lit(False)))
        left = (open_.filter(F.col("out") & ((blocks("n") > 1) | (blocks("o") > 1)))
                .withColumn("ob", F.pmod(h, blocks("o"))).withColumn("mb", all_of("n")).withColumn("left", F.lit(True)))
        rows = right.unionByName(left).select("bucket", "ob", "mb", "rid", "comp", "out", "left")
        return rows.join(self.bags, "rid").groupBy("bucket", "ob", "mb").applyInArrow(_group(self.threshold), _LINK)

    def run(self, members: DataFrame) -> None:
        """``members``: (bucket, rid, size), buckets of two members or more."""
        self.add(self.first_links(members))
        open_ = self.unfinished(members)
        self.add(self.grouped(open_.filter(F.col("o") <= LARGE)))
        large = open_.filter(F.col("o") > LARGE)
        if not large.isEmpty():
            self.add(self.grouped(self.unfinished(self.by_prefix(large))))

    def by_prefix(self, open_: DataFrame) -> DataFrame:
        """The texts of ``open_`` in a bucket for each token of their prefix,
        rarest tokens first. Bags of the threshold have at least ``threshold *
        size`` tokens in common, so their prefixes have one."""
        texts = open_.select("rid", "size").distinct()
        tokens = (texts.join(self.bags, "rid").select("rid", "size", "shingles", "counts")
                  .mapInArrow(_tokens, "rid long, size long, token long"))
        tokens = written(tokens, work_dir(self.spark, "tokens"))
        met = join_hot(tokens, tokens.groupBy("token").agg(F.count(F.lit(1)).alias("held")), ["token"])
        rarest = F.row_number().over(Window.partitionBy("rid").orderBy("held", "token"))
        prefix = F.col("size") - F.ceil(F.col("size") * self.threshold - 1e-6) + 1
        met = met.withColumn("at", rarest).filter(F.col("at") <= prefix)
        return shared(met.select(F.col("token").alias("bucket"), "rid", "size"), self.spark)


def shared(members: DataFrame, spark) -> DataFrame:
    """Members of buckets that have at least two."""
    members = written(members, work_dir(spark, "buckets"))
    many = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    return written(join_hot(members, many, ["bucket"]), work_dir(spark, "shared"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
            shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: id, digest, class_id (the least id of its class)
    and class_size (rows)."""
    spark = docs.sparkSession
    prepare(spark)
    t = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.col(id_col).alias("id"), t.alias("text"), text_key(t).alias("digest"))
    kind = slim.schema["id"].dataType.simpleString()
    rows = written(slim.mapInArrow(_signatures(shingle), f"id {kind}, digest binary, size long, bands array<long>"),
                   work_dir(spark, "signatures"))
    nodes = rows.groupBy("digest").agg(F.first("size").alias("size"), F.first("bands").alias("bands"),
                                       F.min("id").alias("some_id"))
    nodes = written(nodes.withColumn("rid", F.monotonically_increasing_id()), work_dir(spark, "nodes"))
    members = nodes.filter("size > 0").select("rid", "size", F.explode("bands").alias("bucket"))
    members = shared(members.select("bucket", "rid", "size"), spark)
    wanted = members.select("rid").distinct().join(nodes.select("rid", "digest", "some_id"), "rid")
    texts = (slim.join(wanted, (slim.digest == wanted.digest) & slim.id.eqNullSafe(wanted.some_id))
             .select("rid", "text").dropDuplicates(["rid"]))
    bags = written(texts.mapInArrow(_bags(shingle), "rid long, shingles binary, counts binary, fine binary"), work_dir(spark, "bags"))
    search = _Search(nodes, bags, threshold)
    search.run(members)
    comp = nodes.select("digest", "rid")
    comp = comp.withColumn("comp", F.col("rid")) if search.labels is None else (
        comp.join(search.labels.withColumnRenamed("node", "rid"), "rid", "left").withColumn("comp", F.coalesce("comp", "rid")))
    met = written(join_hot(rows.select("id", "digest"), comp.select("digest", "comp"), ["digest"]), work_dir(spark, "classes"))
    named = met.groupBy("comp").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return join_hot(met, named, ["comp"]).select(F.col("id").alias(id_col), "digest", "class_id", "class_size")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
               shingle: int = SHINGLE) -> DataFrame:
    """Rows of ``docs`` that are the document with the least id of their
    class, all columns whole."""
    digest, other = fresh(docs, "digest", "other")
    gone = classes(docs, id_col, text_col, threshold, shingle)
    gone = (gone.filter(~F.col(id_col).eqNullSafe(F.col("class_id")))
            .select(F.col(id_col).alias(other), F.col("digest").alias(f"{other}d")).distinct())
    d = docs.withColumn(digest, text_key(F.col(text_col)))
    return d.join(gone, (d[digest] == gone[f"{other}d"]) & d[id_col].eqNullSafe(gone[other]), "left_anti").drop(digest)
