"""BagMinHash: signatures whose agreement estimates the weighted Jaccard
similarity of bags, sum of least over sum of greatest multiplicities.

Every element of a bag has a Poisson process for each unit of weight level;
its points carry a time and one of ``m`` signature slots, and slot j holds the
least time of a point that falls into it from any level below the element's
weight. Slot j of two bags is equal with exactly the probability of their
weighted Jaccard similarity.

Levels are discretised at the integers (multiplicities are integers, so
nothing is rounded) and the processes are hierarchical. The levels are split
into the dyadic intervals [0, 1), [1, 2), [2, 4), [4, 8), ...; each has one
process whose rate is its length. An interval wholly below the weight uses it
as it is. One that the weight cuts is split in halves: each point goes to a
half by one bit of its hash, so the halves' processes are those of any bag
that cuts elsewhere, and only points in the part below the weight are used. So
a weight of w costs about log2(w) processes, not w.

Points come in order of time and a process stops when its next point is later
than every slot of its bag. All bags of a batch go on together: each round
draws one more point for the processes that are still open.
"""

from __future__ import annotations

import numpy as np

from kiln.llm.words import mix

_U = np.uint64


def _unit(h: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] from hashes."""
    return ((h >> _U(11)).astype(np.float64) + 1.0) * 2.0 ** -53


def _processes(bag: np.ndarray, element: np.ndarray, weight: np.ndarray):
    """The dyadic intervals that each element's weight reaches: (bag, seed,
    begin, length, weight)."""
    top = np.maximum(np.ceil(np.log2(weight)).astype(np.int64), 0)  # last interval reached: 0 is [0, 1)
    n = top + 1
    at = np.repeat(np.arange(len(bag)), n)
    k = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
    begin = np.where(k == 0, 0, 1 << np.maximum(k - 1, 0))
    length = np.where(k <= 1, 1, 1 << np.maximum(k - 1, 0))
    seed = mix(element[at] + mix(k.astype(_U) + _U(0xB5)))
    return bag[at], seed, begin, length, weight[at]


def signatures(bag: np.ndarray, element: np.ndarray, weight: np.ndarray, n_bags: int, m: int) -> np.ndarray:
    """(n_bags, m) slots as 64-bit hashes of their winning points. ``bag`` is
    the bag of each element (0 ... n_bags - 1), ``element`` its hash, ``weight``
    its multiplicity, at least 1. A bag without elements has zeros."""
    best = np.full(n_bags * m, np.inf)
    latest = np.full(n_bags, np.inf)  # the latest slot of each bag
    bag, seed, begin, length, weight = _processes(bag, element, weight.astype(np.int64))
    time = np.zeros(len(bag))
    i = 0
    while len(bag):
        h = mix(seed + _U((2 * i + 1) * 0x9E3779B97F4A7C15 % 2**64))
        time = time - np.log(_unit(h)) / length
        open_ = time <= latest[bag]
        if not open_.all():
            bag, seed, begin, length, weight, time, h = (x[open_] for x in (bag, seed, begin, length, weight, time, h))
        where = mix(h + _U(0xA0761D6478BD642F))
        slot = (where >> _U(32)) % _U(m)
        # the point's level: halves of its interval, chosen by the low bits
        cut = np.flatnonzero(begin + length > weight)
        used = np.ones(len(bag), bool)
        if len(cut):
            level = begin[cut] + ((where[cut] & _U(0xFFFFFFFF)).astype(np.float64) * 2.0 ** -32 * length[cut]).astype(np.int64)
            used[cut] = level < weight[cut]
        flat = bag * m + slot.astype(np.int64)
        np.minimum.at(best, flat[used], time[used])
        i += 1
        if len(bag):
            touched = np.unique(bag)
            latest[touched] = best.reshape(n_bags, m)[touched].max(axis=1)
    out = mix(best.view(_U)).reshape(n_bags, m)
    out[~np.isfinite(best).reshape(n_bags, m).any(axis=1)] = 0
    return out


def bags(h: np.ndarray, first: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bags of ``words``-word shingles of texts whose word hashes are
    ``h[first[i]:first[i + 1]]``: (text, shingle, multiplicity), in order. A
    shorter text that has words is one shingle."""
    from kiln.llm.words import windows
    n = np.diff(first)
    per = np.where(n >= words, n - words + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), per)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per) + first[doc]
    w = windows(h, words)
    full = n[doc] >= words
    shingle = np.zeros(len(doc), np.uint64)
    shingle[full] = w[at[full]]
    for i in np.flatnonzero(~full):
        d = doc[i]
        shingle[i] = windows(h[first[d]:first[d + 1]], int(n[d]))[0] + _U(int(n[d]))
    order = np.lexsort((shingle, doc))
    doc, shingle = doc[order], shingle[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (shingle[1:] != shingle[:-1])
    start = np.flatnonzero(new)
    return doc[start], shingle[start], np.diff(np.append(start, len(doc)))
