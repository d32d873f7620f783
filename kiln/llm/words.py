"""Words of whole texts as numpy arrays: bounds and 64-bit hashes.

A word is a maximal run of characters other than space and ``\\t \\n \\v \\f
\\r`` (``[^\\x20\\x09-\\x0D]+``). All six separators are single bytes in UTF-8
and never part of a longer character, so words are found on the raw bytes of
an Arrow string column, without building Python strings.

The hash of a word is the polynomial ``sum byte_i * B**i`` modulo 2**64 taken
from one running sum over the buffer (subtract at the ends, divide by the
power at the start; B is odd, so powers have inverses), then mixed. Modulo a
power of two, words built by doubling a pattern and its complement meet from
1,024 characters on, whatever B; a word of over ``LONG`` bytes is therefore
hashed by itself with BLAKE2b. The hash depends on the word's bytes only. Buffers are worked through in slices cut at
separators, so memory stays near ``SLICE`` x 30 bytes for any text length.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
LONG = 64  # bytes of a word up to which the polynomial is used
_B = 0x9E3779B97F4A7C15 | 1
_U = np.uint64
_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i < n."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE + 1)
        inv = pow(_B, -1, 1 << 64)
        up = np.full(size, _U(_B), dtype=_U)
        down = np.full(size, _U(inv), dtype=_U)
        up[0] = down[0] = _U(1)
        _POWERS["up"], _POWERS["down"] = np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every input bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo, hi = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    return data[lo:hi], offsets - lo


def _slices(data: np.ndarray, cuts: np.ndarray):
    """Bounds of slices that end at a text's end or at a separator."""
    lo, n = 0, len(data)
    while lo < n:
        hi = min(lo + SLICE, n)
        if hi < n:
            at = int(np.searchsorted(cuts, hi, side="right")) - 1  # a text's end at or before hi
            if cuts[at] > lo:
                hi = int(cuts[at])
            else:  # inside one long text: back to a separator, or on to the next one
                seps = np.flatnonzero(_SEP[data[lo:hi]])
                if len(seps):
                    hi = lo + int(seps[-1]) + 1
                else:
                    end = int(cuts[at + 1])
                    seps = np.flatnonzero(_SEP[data[hi:end]])
                    hi = hi + int(seps[0]) + 1 if len(seps) else end
        yield lo, hi
        lo = hi


def words(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of every text of an Arrow column: (data, start, end, hash, first)
    with byte bounds into ``data``; the words of text i are
    ``first[i]:first[i + 1]``."""
    data, offsets = utf8(column)
    starts, ends, hashes = [], [], []
    for lo, hi in _slices(data, offsets):
        part = data[lo:hi]
        edge = np.empty(len(part) + 1, dtype=bool)  # a text may start or end inside the slice
        edge[:] = False
        inner = offsets[np.searchsorted(offsets, lo):np.searchsorted(offsets, hi, side="right")] - lo
        edge[inner] = True
        word = ~_SEP[part]
        begin = word.copy()
        begin[1:] &= ~word[:-1] | edge[1:-1]
        stop = word.copy()
        stop[:-1] &= ~word[1:] | edge[1:-1]
        s, e = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        up, down = _powers(len(part) + 1)
        run = np.zeros(len(part) + 1, dtype=_U)
        np.cumsum((part.astype(_U) + _U(1)) * up[:len(part)], out=run[1:])
        h = (run[e] - run[s]) * down[s]
        starts.append(s + lo)
        ends.append(e + lo)
        h = mix(h + (e - s).astype(_U))
        for i in np.flatnonzero(e - s > LONG):
            h[i] = int.from_bytes(blake2b(part[s[i]:e[i]].tobytes(), digest_size=8).digest(), "little")
        hashes.append(h)
    cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    s, e, h = cat(starts, np.int64), cat(ends, np.int64), cat(hashes, _U)
    return data, s, e, h, np.searchsorted(s, offsets)


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (``len(h) - n + 1``
    of them), built by doubling: a window of 2k words from the two of k."""
    if len(h) < n:
        return np.zeros(0, _U)
    out, have = h, 1
    while have < n:
        step = min(have, n - have)
        out = double(out[:len(out) - step], out[step:], step)
        have += step
    return out


def double(left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
    """Hash of the window that starts with ``left`` and, ``step`` words on,
    continues with ``right``."""
    return mix(left * _U(0xD6E8FEB86659FD93) + mix(right + _U(step)))
