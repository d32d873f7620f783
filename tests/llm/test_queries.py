"""The registered queries: equal to their SQL, or to plain versions, on the
small tables; the pipeline stage by stage."""

from __future__ import annotations

import os
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import brute
from conftest_paths import SF001, SF01
from kiln.llm import quality
from kiln.llm.registry import ORACLE, QUERIES
from kiln.sources.tables import load
from tools.oracle_check import rows_of, type_diff


@pytest.fixture(scope="module")
def queries():
    import kiln.llm.queries  # noqa: F401
    import corpus_pipeline  # noqa: F401
    return QUERIES


def test_all_are_registered(queries):
    import __spark_entry__ as entry
    assert {int(n[2:].split("_")[0]) for n in queries if n.startswith("op")} == set(range(1, 14))
    assert set(queries) <= set(entry.queries()) and "pipeline" in queries and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", ["op3_chat_format", "op6_exact_dedup", "op10_warc"])
def test_equal_to_sql(spark, duck, queries, name):
    df = queries[name](spark, SF001)
    rows = df.collect()
    cur = duck.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    expected = cur.fetchall()
    assert type_diff(df.schema, duck.sql(ORACLE[name])) == {}
    assert rows_of(df.columns, rows) == rows_of(cols, expected)


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in load(spark, SF001, "documents").select("doc_id", "text").collect()]


def test_op1(spark, queries, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, expected = 0, set()
    for i, t in sorted(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        expected.add((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert {tuple(r) for r in queries["op1_token_ids"](spark, SF001).collect()} == expected


def test_op2(spark, queries, texts):
    expected = brute.near_classes([i for i, _ in texts], [t for _, t in texts])
    got = {r.doc_id: r.class_id for r in queries["op2_near_dedup"](spark, SF001).collect()}
    assert got == {texts[i][0]: c for i, c in expected.items()}


def test_op4(spark, queries, texts):
    expected = {(i, *x) for (i, _), x in zip(texts, brute.removed([t for _, t in texts], 35))}
    assert {tuple(r) for r in queries["op4_substring_dedup"](spark, SF001).collect()} == expected


def test_op5(spark, queries, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in texts}
    got = queries["op5_packing"](spark, SF001).collect()
    assert sum(r["length"] for r in got) == sum(map(len, ids.values()))
    for r in got:
        piece = ids[r.doc_id][r.start:r.start + r["length"]]
        assert r.doc_tokens == len(ids[r.doc_id]) and len(piece) == r["length"] and zlib.crc32(piece.tobytes()) == r.ids_crc32
    fill = Counter()
    for r in got:
        fill[r.sequence_id] += r["length"]
    assert all(n <= 2048 and n & (n - 1) == 0 for n in fill.values())


def test_op7_equals_numpy(spark):
    """The estimates on the larger table, where groups are large enough."""
    got = quality.verdicts(load(spark, SF01, "documents")).collect()
    docs = {r.doc_id: r for r in load(spark, SF01, "documents").collect()}
    stats = {i: brute.base_statistics(r.text) for i, r in docs.items()}
    good = [i for i in docs if not stats[i]["base_failed"]]
    x = {i: np.array(brute.features(stats[i])) for i in good}
    floors = np.array(list(quality.FEATURES.values()))
    groups = {}
    for key in (lambda r: (r.lang, r.source), lambda r: r.lang, lambda r: ""):
        members: dict = {}
        for i in good:
            members.setdefault(key(docs[i]), []).append(i)
        for k, m in members.items():
            if len(m) >= quality.MIN_GROUP:
                groups[k] = brute.mcd(np.array([x[i] for i in m]), floors, quality.H, quality.SCALE, quality.STEPS,
                                      quality.GRID, quality.BINS)
    rejected = 0
    for r in got:
        assert all(r[n] == stats[r["id"]][n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                       "n_repeat_words", "base_failed"))
        if r.base_failed:
            assert not r.kept
            continue
        d = docs[r["id"]]
        mu, cov = next(groups[k] for k in ((d.lang, d.source), d.lang, "") if k in groups)
        diff = x[r["id"]] - mu
        d2 = float(diff @ np.linalg.inv(cov) @ diff)
        assert abs(r.d2 - d2) <= 1e-3 * max(d2, 1)
        assert r.kept == (d2 <= quality.LIMIT)
        rejected += not r.kept
    assert rejected > 0


def test_quality_labels(spark):
    """Every text labelled good that passes the base rules is kept, every bad one goes."""
    v = quality.verdicts(load(spark, SF01, "documents"))
    labels = load(spark, SF01, "labels").withColumnRenamed("doc_id", "id")
    rows = v.filter("NOT base_failed").join(labels, "id").select("quality", "kept").collect()
    assert {(r.quality, r.kept) for r in rows} == {(0, False), (1, True)}


def test_op8(spark, queries, texts):
    got = queries["op8_mixing"](spark, SF001).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, len(brute.words(t))) for i, t in texts)
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)
    total = sum(r["size"] for r in got)
    assert abs(sum(r.taken for r in got) - total) <= 20


def test_op9(spark, queries, texts):
    import re
    got = {r.doc_id: r.text for r in queries["op9_pii"](spark, SF001).collect()}
    found = re.compile(r"[\w.+-]+@[\w.-]+\.\w+|\+1 \(\d{3}\) \d{3}-\d{4}|\b\d{16}\b|\b[0-9a-f]{40}\b", re.I)
    assert set(got) == {i for i, _ in texts}
    private = 0
    for i, t in texts:
        for m in found.findall(t or ""):
            private += 1
            assert m not in got[i]
        if not re.search(r"\d", t or ""):
            assert got[i] == t
    assert private > 0


def test_pipeline(spark, queries):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "exact dedup", "near dedup", "mixing", "packing"]
    docs = load(spark, SF001, "documents")
    columns, before = docs.columns, [tuple(r) for r in docs.collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(before, docs.schema)
        out = stage(spark, docs, SF001)
        assert out.columns == columns
        after = [tuple(r) for r in out.collect()]
        if name == "quality rules":
            expected = {r for r in before if not brute.base_statistics(r[1])["base_failed"]}
            assert set(after) == expected or set(after) < expected
        elif name == "exact dedup":
            last = {}
            for r in before:
                last[r[1]] = max(last.get(r[1], r), r)
            assert set(after) == set(last.values())
        elif name == "near dedup":
            classes = brute.near_classes([r[0] for r in before], [r[1] for r in before])
            assert {r[0] for r in after} == set(classes.values())
        else:
            assert {r[0] for r in after} <= {r[0] for r in before}
            most = Counter(r[0] for r in after)
            assert max(most.values()) <= 3
            words = sum(len(brute.words(r[1])) for r in after)
            assert abs(words - sum(len(brute.words(r[1])) for r in before)) <= 20
        assert after
        before = after
    final = corpus_pipeline.STAGES[-1][1](spark, spark.createDataFrame(before, docs.schema), SF001).collect()
    assert {r.doc_id for r in final} == {r[0] for r in before}


def test_texts_are_read_whole(spark, queries):
    assert os.path.isdir(SF001) and load(spark, SF001, "documents").count() == len(queries["op6_exact_dedup"](spark, SF001).collect())
