"""Whitening, importance resampling and SentencePiece coding against numpy,
plain Python and the library."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

import brute
from conftest_paths import SF001
from kiln.llm import crcgrams, qdwh, queries, resample, sentpiece, whiten
from kiln.sources.tables import load

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# -- whitening ---------------------------------------------------------------

def _check_components(a: np.ndarray) -> None:
    e, v = qdwh.components(a)
    size = max(np.linalg.norm(a), 1e-300)
    assert np.allclose(e, np.linalg.eigvalsh(a)[::-1], atol=1e-13 * size * len(a))
    assert np.allclose(v.T @ v, np.eye(len(a)), atol=1e-13 * len(a))
    assert np.abs(a @ v - v * e).max() <= 1e-13 * size * len(a)


@pytest.mark.parametrize("dim", [1, 2, 3, 8, 64, 130])
def test_components_of_covariances(dim):
    x = np.random.default_rng(dim).normal(size=(5 * dim, dim))
    _check_components(x.T @ x)


def test_components_of_hard_matrices():
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    low = rng.normal(size=(4, 20))
    graded = rng.normal(size=(300, 20)) * np.logspace(0, -7, 20)
    for a in (np.eye(7), np.zeros((4, 4)), np.diag([1.0, 1, 1, 2, 2, 3]), q @ np.diag([5.0] * 10 + [3.0] * 10 + [0.0] * 10) @ q.T,
              low.T @ low, graded.T @ graded, np.diag([-2.0, 1.0, 0.0])):
        _check_components(a)


def _same_whitening(got, vectors, ids):
    kept, n, deviations, white, explained = brute.whitened(vectors)
    by_row = {}
    for r in got:
        by_row.setdefault(r.vec_id, {})[r.component] = r
    assert set(by_row) == {ids[i] for i in kept}
    table = np.array([[by_row[ids[i]][c + 1].whitened for c in range(white.shape[1])] for i in kept])
    sign = np.sign((table * white).sum(axis=0))
    assert np.allclose(table, white * sign, atol=1e-9)
    for i, d in zip(kept, deviations):
        r = by_row[ids[i]][1]
        assert r.deviation == d and r.n == n and abs(r.explained - explained[0]) < 1e-12 and r.identity_error < 1e-9


def test_op11(spark):
    rows = load(spark, SF001, "embeddings").select("vec_id", "embedding").collect()
    got = queries.op11_whitening(spark, SF001).collect()
    assert len(got) == 8 * len(rows)
    _same_whitening(got, [r.embedding for r in rows], [r.vec_id for r in rows])


def _whiten(df, most=8):
    model = whiten.fit(df, "embedding", most)
    return model, whiten.transform(df, "embedding", model)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [[float(np.float32(c)) for c in rng.normal(size=3)] for _ in range(40)]
    odd = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 0.0, 0.0], [1.0, 2.0], [1e30, 0.0, 0.0]]
    rows = [(i, v, "x", 7) for i, v in enumerate([*good, *odd, good[0]])] + [(None, good[1], None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, `whitened` string, _row int")
    model, out = _whiten(df)
    got = out.collect()
    assert out.columns == ["vec_id", "embedding", "_row", "deviation", "whitened"]
    assert model.n == 42 and Counter(r.vec_id for r in got) == Counter([*range(40), 47, None])
    _, n, deviations, white, _ = brute.whitened([*good, good[0], good[1]])
    table = np.array([r.whitened for r in got])
    assert sorted(r.deviation for r in got) == sorted(deviations)
    assert np.allclose(np.sort(np.abs(table), axis=0), np.sort(np.abs(white), axis=0), atol=1e-9)
    assert whiten.identity_error(df, "embedding", model) < 1e-9


def test_whitening_without_spread_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    model, out = _whiten(spark.createDataFrame([(1, [0.5, 0.5])] * 3, schema))
    assert [r.whitened for r in out.collect()] == [[]] * 3 and [r.deviation for r in out.collect()] == [0] * 3
    assert whiten.identity_error(out, "embedding", model) == 0.0
    for rows in ([], [(1, None), (2, [])]):
        model, out = _whiten(spark.createDataFrame(rows, schema))
        assert model.n == 0 and out.collect() == []
    # one direction only: the others have no whitened value
    model, out = _whiten(spark.createDataFrame([(i, [float(i), 1.0]) for i in range(9)], schema))
    assert {len(r.whitened) for r in out.collect()} == {1}


def test_large_deviations_are_exact_or_null():
    x = np.array([[2.0**39, 0.0], [0.0, 0.0]])
    assert whiten._deviations(x, 2, [2**39, 0]) == [None, None]
    assert whiten._deviations(np.array([[2.0**31, 0.0], [0.0, 0.0]]), 2, [2**31, 0]) == [2**62, 2**62]


# -- resampling --------------------------------------------------------------

def test_op12(spark):
    docs = [(r.doc_id, r.text) for r in load(spark, SF001, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in load(spark, SF001, "benchmark").collect()]
    assert {tuple(r) for r in queries.op12_resampling(spark, SF001).collect()} == brute.drawn(docs, target)


def test_gram_checksums(monkeypatch):
    monkeypatch.setattr(crcgrams, "STEP", 100)
    monkeypatch.setattr(crcgrams, "CHUNK", 300)
    monkeypatch.setattr(crcgrams, "CACHE_BYTES", 2000)
    rnd = random.Random(2)
    texts = [None, "", "a", "A é日本 Z9 x_y", "x" * 70_000 + " b " + "é" * 300 + " c",
             " ".join(f"v{rnd.randint(0, 50)}" for _ in range(900)),
             *["".join(rnd.choice("ab é\n-Z0") for _ in range(rnd.randint(0, 80))) for _ in range(300)]]
    got = {}
    for lo, n, portions in crcgrams.Grams().batch(pa.array(texts), 3):
        for of, crc in portions:
            for i, c in zip(of.tolist(), crc.tolist()):
                got.setdefault(lo + i, Counter())[c] += 1
    for i, t in enumerate(texts):
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in folded).split(" ")
        w = [x for x in w if x]
        expected = Counter(zlib.crc32(" ".join(w[j:j + k]).encode()) for k in (1, 2, 3) for j in range(len(w) - k + 1))
        assert got.get(i, Counter()) == expected


def test_draw_of_odd_rows(spark, odd, none):
    target = spark.createDataFrame([("w1 w2 w3 one two",), (None,), ("",)], "text string")
    got = resample.draw(odd, target, percent=50, min_words=20, carry=["lang", "_row"])
    rows = got.collect()
    source = odd.collect()
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "lang", "_row", "rank"]
    assert Counter((r.doc_id, r.lang) for r in rows) == Counter((r.doc_id, r.lang) for r in source)
    fit = [r for r in rows if r.n_words >= 20]
    drawn = sorted((r.rank, r.score) for r in rows if r.rank is not None)
    assert [k for k, _ in drawn] == list(range(1, len(fit) // 2 + 1))
    assert [s for _, s in drawn] == sorted((r.score for r in fit), reverse=True)[:len(drawn)]
    assert all(r.weight == 0 and r.n_features == 0 for r in rows if r.doc_id in (4, 5, 6, 13))
    assert resample.draw(none, target).collect() == []
    assert {r.rank for r in resample.draw(odd, target, percent=1).collect()} == {None}
    assert len(resample.draw(odd, target.filter("1 = 0")).collect()) == len(source)


@pytest.mark.parametrize("parts", [1, 7])
def test_cutoff_is_exact(spark, tmp_path, parts):
    rnd = random.Random(5)
    keys = sorted({(rnd.choice([-5, 0, 0, 0, 9]), rnd.randint(0, 1), rnd.randint(0, 20), i) for i in range(500)})
    mixed = rnd.sample(keys, len(keys))
    path = f"{tmp_path}/keys-{parts}"
    spark.createDataFrame(mixed, "neg long, no_id long, id long, at long").repartition(parts).write.parquet(path)
    table = spark.read.parquet(path)
    for n in (1, 2, 17, len(keys) // 2, len(keys)):
        assert resample.cutoff(table, n) == keys[n - 1]
    assert resample.cutoff(table, 0) is None


# -- SentencePiece -----------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def _encoded(texts) -> list[list[int]]:
    out = []
    for ids, n in sentpiece.Coder(MODEL).encode(texts):
        out += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    return out


def test_ids_equal_the_library(library):
    rnd = random.Random(1)
    entries = [library.id_to_piece(i).replace("▁", " ") for i in range(300, 31000)]
    texts = [None, "", " ", "   a", " " * 5 + "x" + " " * 40 + "y" + " " * 33, "▁▁a▁b", "é日本語\n\n\tfoo  bar\0 z", "🙂🙂 x",
             "a" * 3000, "ab" * 2000, " " * 2000, "<s></s><unk><0x41>"]
    texts += ["".join(rnd.choice(entries) for _ in range(rnd.randint(1, 50))) for _ in range(1500)]
    for alphabet in ("abn i", "  \n=-*/#", "".join(map(chr, range(32, 127)))):
        texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 200))) for _ in range(800)]
    assert _encoded(texts) == [library.encode(t or "") for t in texts]


def test_long_texts_are_cut_between_pieces(library, monkeypatch):
    monkeypatch.setattr(sentpiece, "SLICE_CHARS", 50)
    monkeypatch.setattr(sentpiece, "CACHE_CHARS", 200)
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("xyz  é") for _ in range(n)) for n in (0, 1, 49, 51, 500, 5000)] + ["q" * 400, " " * 400]
    assert _encoded(texts) == [library.encode(t) for t in texts]


def test_op13(spark, library):
    expected = set()
    for r in load(spark, SF001, "documents").select("doc_id", "text").collect():
        ids = library.encode(r.text or "")
        expected.add((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                      hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert {tuple(r) for r in queries.op13_sentencepiece(spark, SF001).collect()} == expected


def test_coding_of_odd_rows(odd, none, library):
    coded = sentpiece.encode(odd, MODEL, to="digest")  # replaces a column of that name
    assert sorted(coded.columns) == sorted(odd.columns)
    rows = coded.collect()
    assert Counter((r.doc_id, r.text, tuple(r.digest)) for r in rows) == \
        Counter((r.doc_id, r.text, tuple(library.encode(r.text or ""))) for r in odd.collect())
    back = sentpiece.decode(coded, MODEL, "digest", "again").collect()
    assert all(r.again == library.decode(r.digest) for r in back)
    assert sentpiece.encode(none, MODEL).collect() == []


def test_decoding_of_null_ids(spark, library):
    df = spark.createDataFrame([(1, None), (2, []), (3, [None, 263, None, 1243]), (4, [263])], "k int, ids array<int>")
    got = {r.k: r.text for r in sentpiece.decode(df, MODEL).collect()}
    assert got == {1: None, 2: "", 3: library.decode([263, 1243]), 4: library.decode([263])}
