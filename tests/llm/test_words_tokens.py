from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from brute import WORD
from kiln.llm import words as W
from kiln.llm.idfile import decode_values, encode_values, pack_segment, unpack_segment
from kiln.llm.tokens import Encoder

PARTS = ["a", "B", "'s", " ", "  ", "\n", "\n\n", "\t", "é", "é", "́", "<|endoftext|>", " ", "　", "\x85",
         "\x1c", "9", "12", "!?", "##", "日本", "😀", "ß", "Σ", "\x0b", "\x0c", "\r\n", "it's", " ", "\x00"]


def _texts(n: int) -> list:
    rnd = random.Random(5)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 25))) for _ in range(n)] + [None, "", " ", "\n \n"]


def test_words_are_those_of_the_pattern(monkeypatch):
    monkeypatch.setattr(W, "SLICE", 64)
    texts = [*_texts(300), "x" * 500 + " y", "y"]
    data, s, e, h, first = W.words(pa.array(texts))
    by_word: dict = {}
    for i, t in enumerate(texts):
        found = [data[a:b].tobytes().decode() for a, b in zip(s[first[i]:first[i + 1]], e[first[i]:first[i + 1]])]
        assert found == WORD.findall(t or "")
        for w, x in zip(found, h[first[i]:first[i + 1]]):
            assert by_word.setdefault(w, x) == x
    assert len(set(by_word.values())) == len(by_word)


def test_windows_are_equal_only_for_equal_words():
    h = W.mix(np.array([1, 2, 3, 1, 2, 3, 4], dtype=np.uint64))
    w = W.windows(h, 3)
    assert w[0] == w[3] and len(set(w.tolist())) == 4
    assert len(W.windows(h, 8)) == 0


@pytest.mark.parametrize("file,kind", [("word_bpe_49k.json", "word"), ("byte_bpe_50k.json", "space")])
def test_ids_equal_the_library(file, kind):
    from tokenizers import Tokenizer
    texts = _texts(1500)
    expected = [x.ids + [1] for x in Tokenizer.from_file(public_tokenizers.path(file))
                .encode_batch([t or "" for t in texts], add_special_tokens=False)]
    enc, got = Encoder(public_tokenizers.path(file), kind), []
    for column in (pa.array(texts), pa.array([*texts[:7], *texts]).slice(7)):
        got = [x.tolist() for lo, ids, n in enc.encode(column) for x in np.split(ids, np.cumsum(n)[:-1])]
        assert got == expected


def test_value_code_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        control, data = encode_values(v)
        assert len(control) == -(-n // 4)
        assert np.array_equal(decode_values(control, data, n), v)


def test_segment_round_trip_and_ranks():
    ids = np.array([7, 7, 7, 300, 300, 5, 1], np.uint32)
    raw = pack_segment(np.array([4, 0]), np.array([False, True]), np.array([4, 3]), ids)
    doc, null, counts, back = unpack_segment(raw)
    assert back.tolist() == ids.tolist() and doc.tolist() == [4, 0] and null.tolist() == [False, True] and counts.tolist() == [4, 3]
    with pytest.raises(ValueError):
        unpack_segment(raw[:-1] + b"\x00")


def _thue_morse(levels: int, a: str, b: str) -> tuple[str, str]:
    for _ in range(levels):
        a, b = a + b, b + a
    return a, b


def test_doubled_patterns_have_different_hashes():
    """Words that meet under any polynomial modulo a power of two."""
    for levels in range(1, 13):
        x, y = _thue_morse(levels, "a", "b")
        _, _, _, h, _ = W.words(pa.array([f"{x} {y} ab{x} ab{y}"]))
        assert len(set(h.tolist())) == 4, levels


def test_ids_of_doubled_patterns_are_their_own():
    import public_tokenizers
    from tokenizers import Tokenizer

    from kiln.llm.tokens import Encoder
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [" ".join(_thue_morse(n, "ab", "ba")) for n in (9, 10)]
    texts += [t[::-1] for t in texts]
    library = Tokenizer.from_file(path)
    for _, ids, n in Encoder(path, "space").encode(pa.array(texts)):
        for got, t in zip(np.split(ids, np.cumsum(n)[:-1]), texts):
            assert got.tolist() == [*library.encode(t, add_special_tokens=False).ids, 1]
