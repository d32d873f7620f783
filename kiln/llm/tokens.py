"""Token ids of whole texts, one BPE call per distinct piece.

Both vocabularies split a text into words before any merge, and no token spans
a boundary between a non-blank character and a following blank. So a text may
be cut there, each distinct piece is tokenised once per worker, and a batch's
ids are gathered by numpy:

* ``"word"`` (white space is dropped by the tokenizer): a piece is a word;
* ``"space"`` (white space belongs to the tokens): a piece is a run of blanks
  with the word that follows it. Texts that hold other Unicode white space are
  encoded as a whole, since the run before a cut may then go on behind it.

``kind`` is one of these two. Pieces are told apart by 64-bit hashes. The cache
is bounded by ``CACHE`` pieces; when full it is begun anew.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from kiln.llm import words as W

END_ID = 1
CACHE = 1_000_000
SLICE_BYTES = 4 << 20  # text worked on at once; a longer single text alone

_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = Encoder(path, kind)
    return _ENCODERS[path, kind]


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the runs [start, start + len), one after another."""
    ends = np.cumsum(lens)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lens), lens)


def _other_blanks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text: does it hold white space beyond the six ASCII separators?"""
    # fixed values: U+0085, U+00A0, U+1680, U+2000-200A, U+2028, U+2029, U+202F, U+205F, U+3000 in UTF-8
    three = {(0xE1, 0x9A): [0x80], (0xE2, 0x80): [*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF],
             (0xE2, 0x81): [0x9F], (0xE3, 0x80): [0x80]}
    at = np.flatnonzero(data[:-1] == 0xC2)
    hits = [at[np.isin(data[at + 1], [0x85, 0xA0])]]
    lead = np.flatnonzero((data[:-2] >= 0xE1) & (data[:-2] <= 0xE3)) if len(data) > 2 else np.zeros(0, int)
    for (a, b), c in three.items():
        x = lead[(data[lead] == a) & (data[lead + 1] == b)]
        hits.append(x[np.isin(data[x + 2], c)])
    found = np.concatenate(hits)
    return np.bincount(np.searchsorted(offsets, found, side="right") - 1, minlength=len(offsets) - 1)[:len(offsets) - 1] > 0


class Encoder:
    def __init__(self, path: str, kind: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer
        if kind not in ("word", "space"):
            raise ValueError(f"kind must be 'word' or 'space', not {kind!r}")
        self.kind, self.tok = kind, Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.start, self.len = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _pieces(self, column):
        """(data, piece start, end, hash, first piece of each text)."""
        data, s, e, h, first = W.words(column)
        if self.kind == "word":
            return data, s, e, h, first
        _, offsets = W.utf8(column)
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        begin = np.empty_like(s)
        begin[1:] = e[:-1]
        begin = np.maximum(begin, offsets[doc]) if len(s) else begin
        if len(s):
            begin[0] = offsets[doc[0]]
        # blanks behind the last word are a piece of their own
        last = np.where(np.diff(first) > 0, e[np.maximum(first[1:] - 1, 0)] if len(e) else 0, offsets[:-1])
        tail = np.flatnonzero(last < offsets[1:])
        gap = s - begin
        blank = np.where(gap == 1, data[np.minimum(begin, max(len(data) - 1, 0))] if len(data) else 0, 0).astype(np.uint64)
        for i in np.flatnonzero(gap > 1):
            blank[i] = zlib.crc32(data[begin[i]:s[i]]) + (int(gap[i]) << 32)
        h = W.mix(h + W.mix(blank))
        th = np.array([zlib.crc32(data[last[i]:offsets[i + 1]]) + (int(offsets[i + 1] - last[i]) << 32) for i in tail],
                      dtype=np.uint64)
        at = first[tail + 1]
        begin, e, h = (np.insert(begin, at, last[tail]), np.insert(e, at, offsets[tail + 1]),
                       np.insert(h, at, W.mix(th + np.uint64(7))))
        more = np.zeros(len(first), np.int64)
        more[tail + 1] = 1
        return data, begin, e, h, first + np.cumsum(more)

    def _lookup(self, data, s, e, h) -> tuple[np.ndarray, np.ndarray]:
        """Start and length in ``self.flat`` of each piece's ids."""
        u, at, inv = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) > CACHE:
            self._forget()
        pos = np.searchsorted(self.keys, u)
        known = np.zeros(len(u), bool)
        inside = pos < len(self.keys)
        known[inside] = self.keys[pos[inside]] == u[inside]
        new = np.flatnonzero(~known)
        if len(new):
            buf = data.tobytes()
            texts = [buf[s[i]:e[i]].decode("utf-8", "replace") for i in at[new]]
            ids = [x.ids for x in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((i for x in ids for i in x), np.uint32, int(n.sum()))
            keys = np.concatenate([self.keys, u[new]])
            order = np.argsort(keys, kind="stable")
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(n) - n])[order]
            self.len = np.concatenate([self.len, n])[order]
            self.keys, self.flat = keys[order], np.concatenate([self.flat, flat])
            pos = np.searchsorted(self.keys, u)
        return self.start[pos][inv], self.len[pos][inv]

    def _encode_slice(self, column) -> tuple[np.ndarray, np.ndarray]:
        data, s, e, h, first = self._pieces(column)
        n_docs = len(first) - 1
        if len(h):
            start, n = self._lookup(data, s, e, h)
        else:
            start = n = np.zeros(0, np.int64)
        total = np.concatenate([[0], np.cumsum(n)])
        per_doc = total[first[1:]] - total[first[:-1]] + 1
        ends = np.cumsum(per_doc)
        out = np.empty(int(ends[-1]) if n_docs else 0, np.uint32)
        is_end = np.zeros(len(out), bool)
        is_end[ends - 1] = True
        out[~is_end] = self.flat[ragged(start, n)]
        out[is_end] = END_ID
        if self.kind == "space" and len(data) > 1:
            odd = np.flatnonzero(_other_blanks(data, W.utf8(column)[1]))
            if len(odd):
                parts = np.split(out, ends[:-1])
                for i in odd:
                    ids = self.tok.encode(column[int(i)].as_py(), add_special_tokens=False).ids
                    parts[i] = np.array([*ids, END_ID], np.uint32)
                out, per_doc = np.concatenate(parts), np.array([len(x) for x in parts])
        return out, per_doc

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Slices of a batch's texts: (number of the first text, ids of all
        its texts one after another, each ended by END_ID, ids per text).
        Null counts as empty."""
        _, offsets = W.utf8(column)
        lo = 0
        while lo < len(column):
            hi = max(int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, side="right")) - 1, lo + 1)
            ids, n = self._encode_slice(column.slice(lo, hi - lo))
            yield lo, ids, n
            lo = hi
