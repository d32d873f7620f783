"""CRC-32 of word n-grams, from the words' own checksums.

The checksum of two byte strings one after the other is that of the first,
advanced by the length of the second, xor that of the second. Advancing is
linear over bits, so for each length it is four tables of 256 entries. A run
that grows by a space and a word thus costs four table lookups in numpy,
whatever its bytes; each distinct word is read once per worker.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from kiln.llm.words import utf8

# words: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z; everything else is a blank
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))
_MARK = b"A"            # stands between texts; no folded word has a capital letter
_BETWEEN = b" A "
CHUNK = 4 << 20        # bytes of text split at once
CACHE_BYTES = 8 << 20  # bytes of distinct words kept per worker
STEP = 1 << 20         # words whose n-grams are computed at once


def _zero_byte() -> np.ndarray:
    """Images of the 32 bits under appending a zero byte."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    table = np.array([zlib.crc32(bytes([i])) ^ zlib.crc32(b"\0") for i in range(256)], np.uint32)
    return table[bits & 0xFF] ^ (bits >> np.uint32(8))


def _apply(matrix: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros_like(values)
    for b in range(32):
        out ^= np.where((values >> np.uint32(b)) & np.uint32(1), matrix[b], np.uint32(0))
    return out


class _Numbers(dict):
    """Number of each distinct word, given when the word is first met."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


class Grams:
    """Words and the checksums of their n-grams for one worker."""

    def __init__(self):
        self.powers = [_zero_byte()]  # appending 2**i zero bytes
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbers({_MARK: 0})
        self.known.new = []
        self.held = 0
        self.crc, self.behind, self.row = np.zeros(1, np.uint32), np.zeros(1, np.uint32), np.zeros(1, np.int64)
        self.row_of: dict[int, int] = {}
        self.tables = np.zeros(0, np.uint32)

    def _rows(self, lengths: list[int]) -> None:
        """Advance tables for lengths not met before."""
        new = [n for n in dict.fromkeys(lengths) if n not in self.row_of]
        made = [self.tables]
        for n in new:
            matrix, i = np.uint32(1) << np.arange(32, dtype=np.uint32), 0
            while n >> i:
                while len(self.powers) <= i:
                    self.powers.append(_apply(self.powers[-1], self.powers[-1]))
                if n >> i & 1:
                    matrix = _apply(self.powers[i], matrix)
                i += 1
            byte = np.arange(256, dtype=np.uint32)
            made += [_apply(matrix, byte << np.uint32(8 * k)) for k in range(4)]
        if new:
            self.row_of.update(zip(new, range(len(self.row_of), len(self.row_of) + len(new))))
            self.tables = np.concatenate(made)

    def _learn(self) -> None:
        """Checksums and lengths of the words met since the last call."""
        new, self.known.new = self.known.new, []
        if new:
            spaced = [len(w) + 1 for w in new]
            self._rows(spaced)
            add = lambda have, values, t: np.concatenate([have, np.array(values, t)])
            self.crc = add(self.crc, list(map(zlib.crc32, new)), np.uint32)
            self.behind = add(self.behind, [zlib.crc32(b" " + w) for w in new], np.uint32)
            self.row = add(self.row, [1024 * self.row_of[n] for n in spaced], np.int64)
            self.held += sum(spaced)

    def _followed(self, crc: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Checksum of strings with ``crc``, each followed by a space and a word."""
        t, at = self.tables, self.row[words]
        out = self.behind[words]
        out ^= t.take(at + (crc & np.uint32(0xFF)))
        out ^= t.take(at + (256 + ((crc >> np.uint32(8)) & np.uint32(0xFF))))
        out ^= t.take(at + (512 + ((crc >> np.uint32(16)) & np.uint32(0xFF))))
        out ^= t.take(at + (768 + (crc >> np.uint32(24))))
        return out

    def _numbers(self, folded: bytes) -> np.ndarray:
        """Number of each word of folded text in this worker's list of words."""
        parts, lo = [], 0
        while lo < len(folded):
            hi = len(folded) if lo + CHUNK >= len(folded) else folded.find(b" ", lo + CHUNK)
            hi = len(folded) if hi < 0 else hi
            words = folded[lo:hi].split()
            parts.append(np.fromiter(map(self.known.__getitem__, words), np.int32, len(words)))
            lo = hi
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def batch(self, column: pa.Array, most: int) -> Iterator[tuple[int, np.ndarray, Iterator]]:
        """Stretches of a column's texts: (number of the first text, words per
        text, pairs (text within the stretch, checksum) of all runs of 1 to
        ``most`` words, in portions). Null has no words."""
        data, offsets = utf8(column)
        lo = 0
        while lo < len(column):
            if self.held > CACHE_BYTES:
                self._forget()
            hi = max(int(np.searchsorted(offsets, offsets[lo] + CHUNK, side="right")) - 1, lo + 1)
            raw = data[offsets[lo]:offsets[hi]].tobytes().translate(_FOLD)
            at = (offsets[lo:hi + 1] - offsets[lo]).tolist()
            numbers = self._numbers(_BETWEEN.join([raw[a:b] for a, b in zip(at[:-1], at[1:])]))
            self._learn()
            mark = numbers == 0
            n = np.diff(np.flatnonzero(np.concatenate([[True], mark, [True]]))) - 1
            yield lo, n, self._grams(numbers[~mark], n, most)
            lo = hi

    def _grams(self, words: np.ndarray, n: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        text = np.repeat(np.arange(len(n)), n)
        for lo in range(0, len(words), STEP):
            w, of = words[lo:lo + STEP + most - 1], text[lo:lo + STEP + most - 1]
            run = self.crc[w[:min(STEP, len(words) - lo)]]
            yield of[:len(run)], run
            for k in range(1, most):
                run = run[:max(min(len(run), len(w) - k), 0)]
                if not len(run):
                    break
                run = self._followed(run, w[k:k + len(run)])
                same = of[:len(run)] == of[k:k + len(run)]
                yield of[:len(run)][same], run[same]
