"""SentencePiece BPE ids of whole texts by vectorised merge rounds, and back.

A text gets the model's leading blank and is cut into pieces, each a run of
blanks with the word behind it. No vocabulary entry of a model with
``treat_whitespace_as_suffix`` off holds a blank behind another character, so
no merge crosses such a cut; the constructor checks that. Each distinct piece
is encoded once per worker, all new pieces of a slice together:

1. their characters become one flat symbol array. A piece is cut further into
   segments between characters that no vocabulary entry holds side by side;
2. every round takes the least pair rank of each segment (one segmented
   minimum), merges its occurrences from the left without overlap, all at
   once, and compacts the arrays. A segment without a pair is finished;
3. a merge may make a pair that the library would take before the remaining
   occurrences (an entry of better or equal rank that holds the merged one).
   Such a segment, found by looking those pairs up before merging, is finished
   one merge at a time in the library's order instead;
4. characters outside the vocabulary become their byte entries.

The cache of pieces is begun anew when it holds over ``CACHE_CHARS``
characters. A text is worked off in stretches of ``SLICE_CHARS`` cut between
pieces, so memory does not follow its length beyond its own ids. The work is
per row: no shuffle.

Defined results: a null text counts as empty and has no ids; null ids decode
to null, a null entry among ids is left out; repeated rows are encoded each
for itself; an empty table gives an empty result; all other columns are
carried along, and one that has the name of the new column is replaced.
"""

from __future__ import annotations

import heapq
import os
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kiln.llm.common import prepare
from kiln.llm.tokens import ragged

SLICE_CHARS = 2 << 20
CACHE_CHARS = 4 << 20
_PIECE = re.compile(" *[^ ]+| +")
_CUT = re.compile("(?<=[^ ])(?= )")
_NONE = np.int32(2**31 - 1)
_CODERS: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """This worker's coder for a model file."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


class Coder:
    """Encoder and decoder of one BPE model file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        norm = model.normalizer_spec
        kinds = pb.ModelProto.SentencePiece
        if (model.trainer_spec.model_type != pb.TrainerSpec.BPE or norm.precompiled_charsmap
                or norm.remove_extra_whitespaces or not norm.escape_whitespaces or not model.trainer_spec.byte_fallback
                or any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces)):
            raise ValueError("only BPE models with byte fallback, without normalisation or own pieces")
        self.prefix = " " if norm.add_dummy_prefix else ""
        entries = {p.piece.replace("▁", " "): i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        if any(re.search("[^ ] ", e) for e in entries):
            raise ValueError("an entry holds a blank behind another character")
        if any(c not in entries for e in entries for c in e):
            raise ValueError("an entry holds a character that is no entry")
        self.size = len(model.pieces)
        scores = np.array([p.score for p in model.pieces])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)  # equal scores share a rank
        pairs, beside = {}, set()
        for e, i in entries.items():
            beside.update((entries[a], entries[b]) for a, b in zip(e, e[1:]))
            for cut in range(1, len(e)):
                if e[:cut] in entries and e[cut:] in entries:
                    pairs[entries[e[:cut]] * self.size + entries[e[cut:]]] = i
        self.pairs = pairs
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ids = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int32)
        self.beside = np.array(sorted(a * self.size + b for a, b in beside), np.int64)
        self.char_id = np.full(0x110000, -1, np.int32)
        for e, i in entries.items():
            if len(e) == 1:
                self.char_id[ord(e)] = i
        self.byte_id = np.array([self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.start, self.len = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    # -- merging ---------------------------------------------------------

    def _merged(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry that each pair of symbols merges to, and its rank (_NONE: no entry)."""
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        ids = np.where(self.pair_keys[at] == key, self.pair_ids[at], -1)
        return ids, np.where(ids >= 0, self.rank[ids], _NONE)

    def _in_order(self, sym: list[int]) -> list[tuple[int, int]]:
        """One segment merged pair by pair, the best rank first and of equal
        ones the leftmost: (symbol number, entry) of what is left."""
        n = len(sym)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, int, int, int]] = []
        pairs = self.pairs

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                m = pairs.get(sym[i] * self.size + sym[j])
                if m is not None:
                    heapq.heappush(heap, (int(self.rank[m]), i, sym[i], sym[j], m))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i] if sym[i] == a else n
            if j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = m, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [(i, s) for i, s in enumerate(sym) if s >= 0]

    def _rounds(self, sym: np.ndarray, seg: np.ndarray, out: np.ndarray, pos: np.ndarray) -> None:
        """Merge all segments; what is left of each is put into ``out`` at the
        place of its first character."""
        ids = np.full(len(sym), -1, np.int32)
        rank = np.full(len(sym), _NONE, np.int32)
        inner = np.flatnonzero(seg[:-1] == seg[1:])
        ids[inner], rank[inner] = self._merged(sym[inner], sym[inner + 1])
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]]))
            size = np.diff(np.append(first, len(sym)))
            best = np.repeat(np.minimum.reduceat(rank, first), size)
            open_ = best < _NONE
            if not open_.all():
                out[pos[~open_]] = sym[~open_]
                sym, seg, pos, ids, rank, best = (x[open_] for x in (sym, seg, pos, ids, rank, best))
                if not len(sym):
                    return
            hit = np.flatnonzero(rank == best)
            run = np.concatenate([[True], np.diff(hit) != 1])  # overlapping occurrences: every other one
            number = np.arange(len(hit))
            take = hit[(number - number[run][np.cumsum(run) - 1]) % 2 == 0]
            unsafe = self._unsafe(sym, seg, ids, best, take)
            if len(unsafe):
                one = np.isin(seg, unsafe)
                bounds = np.flatnonzero(np.diff(np.concatenate([[-1], np.where(one, seg, -1), [-1]])))
                for lo, hi in zip(bounds[:-1], bounds[1:]):
                    if one[lo]:
                        for i, s in self._in_order(sym[lo:hi].tolist()):
                            out[pos[lo + i]] = s
                mark = np.zeros(len(sym), bool)
                mark[take] = True
                sym, seg, pos, ids, rank = (x[~one] for x in (sym, seg, pos, ids, rank))
                take = np.flatnonzero(mark[~one])
                if not len(sym):
                    return
            sym[take] = ids[take]
            keep = np.ones(len(sym), bool)
            keep[take + 1] = False
            at = take - np.arange(len(take))  # place of the merged symbol after compaction
            sym, seg, pos, ids, rank = (x[keep] for x in (sym, seg, pos, ids, rank))
            touched = np.zeros(len(sym), bool)  # pairs that the merged symbols are part of
            touched[at] = touched[np.maximum(at - 1, 0)] = True
            new = np.flatnonzero(touched)
            ends = np.append(seg[1:] != seg[:-1], True)[new]
            ids[new[ends]], rank[new[ends]] = -1, _NONE
            new = new[~ends]
            ids[new], rank[new] = self._merged(sym[new], sym[new + 1])

    def _unsafe(self, sym, seg, ids, best, take) -> np.ndarray:
        """Segments in which a merge makes a pair that goes before a later
        merge of the same round."""
        more = np.concatenate([seg[take[1:]] == seg[take[:-1]], [False]])  # all but a segment's last merge
        if not more.any():
            return np.zeros(0, seg.dtype)
        t = np.flatnonzero(more)
        at, m, limit, own = take[t], ids[take[t]], best[take[t]], seg[take[t]]
        right = np.minimum(at + 2, len(sym) - 1)
        bad = (at + 2 < len(sym)) & (seg[right] == own) & (self._merged(m, sym[right])[1] <= limit)
        left = np.maximum(at - 1, 0)
        prev = take[np.maximum(t - 1, 0)]
        beside = np.where((t > 0) & (prev == at - 2), ids[prev], sym[left])
        bad |= (at > 0) & (seg[left] == own) & (self._merged(beside, m)[1] <= limit)
        return np.unique(own[bad])

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after another, and how many each has."""
        text = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        owner = np.repeat(np.arange(len(pieces)), lens)
        sym = self.char_id[text]
        key = sym[:-1].astype(np.int64) * self.size + sym[1:]
        at = np.minimum(np.searchsorted(self.beside, key), len(self.beside) - 1)
        joined = (self.beside[at] == key) & (owner[1:] == owner[:-1]) & (sym[:-1] >= 0) & (sym[1:] >= 0)
        seg = np.cumsum(np.concatenate([[True], ~joined]))
        out = np.full(len(text), -1, np.int32)
        known = np.flatnonzero(sym >= 0)
        self._rounds(sym[known], seg[known], out, known)
        foreign = np.flatnonzero(sym < 0)
        count = (out >= 0).astype(np.int64)
        if len(foreign):
            raw = [chr(c).encode("utf-8", "replace") for c in text[foreign].tolist()]
            count[foreign] = [len(b) for b in raw]
        ids = np.repeat(out, count)
        if len(foreign):
            ids[ragged((np.cumsum(count) - count)[foreign], count[foreign])] = \
                self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        return ids, np.bincount(owner, weights=count, minlength=len(pieces)).astype(np.int64)

    def _stretch(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Start and length in ``self.flat`` of the ids of each piece."""
        if self.chars > CACHE_CHARS:
            self._forget()
        known = self.known
        new = list(dict.fromkeys(p for p in pieces if p not in known))
        if new:
            ids, n = self._encode_pieces(new)
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(n) - n])
            self.len = np.concatenate([self.len, n])
            self.flat = np.concatenate([self.flat, ids])
            self.chars += sum(map(len, new))
        at = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        return self.start[at], self.len[at]

    def _long(self, text: str) -> np.ndarray:
        """Ids of one text in stretches of about SLICE_CHARS, cut between pieces."""
        parts, lo = [], 0
        while lo < len(text):
            cut = _CUT.search(text, lo + SLICE_CHARS)
            hi = cut.start() if cut else len(text)
            start, n = self._stretch(_PIECE.findall(text[lo:hi]))
            parts.append(self.flat[ragged(start, n)])
            lo = hi
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids one after another, ids per text) of successive texts."""
        lo = 0
        while lo < len(texts):
            hi, chars = lo, 0
            while hi < len(texts) and (hi == lo or chars + len(texts[hi] or "") <= SLICE_CHARS):
                chars += len(texts[hi] or "")
                hi += 1
            prepared = [self.prefix + t.replace("▁", " ") if t else "" for t in texts[lo:hi]]
            if hi - lo == 1:
                ids = self._long(prepared[0])
                yield ids, np.array([len(ids)], np.int64)
            else:
                cut = [_PIECE.findall(t) for t in prepared]
                start, n = self._stretch([p for c in cut for p in c])
                ends = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))
                total = np.concatenate([[0], np.cumsum(n)])
                yield self.flat[ragged(start, n)], np.diff(total[np.concatenate([[0], ends])])
            lo = hi

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def _model_path(model: str) -> str:
    """The file as this worker finds it: by its own path or, if it was handed
    over with ``addFile``, by its name."""
    return model if os.path.exists(model) else SparkFiles.get(os.path.basename(model))


def _with(batch: pa.RecordBatch, lo: int, hi: int, schema: pa.Schema, to: str, values: pa.Array) -> pa.RecordBatch:
    part = batch.slice(lo, hi - lo)
    return pa.RecordBatch.from_arrays([values if f.name == to else part.column(f.name) for f in schema], schema=schema)


def _out_schema(batch: pa.RecordBatch, to: str, kind: pa.DataType) -> pa.Schema:
    return pa.schema([f for f in batch.schema if f.name.lower() != to.lower()] + [pa.field(to, kind)])


def _result(df: DataFrame, to: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema if f.name.lower() != to.lower()] + [T.StructField(to, kind)])


def encode(df: DataFrame, model: str, text: str = "text", to: str = "ids") -> DataFrame:
    """``df`` with the ids of its whole texts as ``to`` (array of int), without
    begin or end ids."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(_model_path(model))
        for b in batches:
            schema, lo = _out_schema(b, to, pa.list_(pa.int32())), 0
            for ids, n in c.encode(b.column(text).to_pylist()):
                at = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(ids))
                yield _with(b, lo, lo + len(n), schema, to, lists)
                lo += len(n)
    return df.mapInArrow(run, _result(df, to, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, model: str, ids: str = "ids", to: str = "text") -> DataFrame:
    """``df`` with the text of its ids as ``to``. An id that the model does not
    have is an error."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(_model_path(model))
        for b in batches:
            schema, column, lo = _out_schema(b, to, pa.string()), b.column(ids), 0
            while lo < b.num_rows:  # lists of about SLICE_CHARS ids as Python numbers at a time
                hi, chars = lo, 0
                while hi < b.num_rows and (hi == lo or chars < SLICE_CHARS):
                    chars += len(column[hi].values) if column[hi].is_valid else 0
                    hi += 1
                texts = [None if x is None else c.decode([i for i in x if i is not None] if None in x else x)
                         for x in column.slice(lo, hi - lo).to_pylist()]
                yield _with(b, lo, hi, schema, to, pa.array(texts, pa.string()))
                lo = hi
    return df.mapInArrow(run, _result(df, to, T.StringType()))
