"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def removed(texts: list[str | None], window: int) -> list[tuple[int, int, str]]:
    """n_words, n_removed, kept_sha256 of each text."""
    all_words = [words(t) for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in all_words for i in range(len(w) - window + 1))
    out = []
    for w in all_words:
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = True
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def bag(text: str | None, shingle: int = 5) -> Counter:
    w = words(text)
    if not w:
        return Counter()
    if len(w) < shingle:
        return Counter([tuple(w)])
    return Counter(tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1))


def weighted_jaccard(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 0.0


def near_classes(ids: list, texts: list, threshold: float = 0.8) -> dict:
    """Row number -> least id of its class (equal texts, and links)."""
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    bags = [bag(t) for t in texts]
    by_shingle = defaultdict(list)
    for i, b in enumerate(bags):
        meets = Counter(j for s in b for j in by_shingle[s])
        for j in meets:
            if weighted_jaccard(b, bags[j]) >= threshold:
                root[find(i)] = find(j)
        for s in b:
            by_shingle[s].append(i)
    first = {}
    for i, t in enumerate(texts):
        root[find(i)] = find(first.setdefault(t or "", i))
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return {i: least.get(find(i)) for i in range(len(ids))}


def base_statistics(text: str | None) -> dict:
    t = text or ""
    w = words(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = Counter(zip(w, w[1:], w[2:]))
    inside = np.zeros(len(w), bool)
    for i in range(len(w) - 2):
        if seen[w[i], w[i + 1], w[i + 2]] > 1:
            inside[i:i + 3] = True
    n, r = len(w), int(inside.sum())
    return {"n_words": n, "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": r,
            "marks": sum(c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for c in t),
            "base_failed": n < 50 or 100 * r > 50 * n}


def features(s: dict) -> list[float]:
    n, chars = max(s["n_words"], 1), max(s["word_chars"], 1)
    return [np.log(n), np.log(chars / n), *[np.sqrt(s[k] / n) for k in ("n_symbols", "n_dup_lines", "n_repeat_words")],
            np.sqrt(s["marks"] / chars)]


def mcd(x: np.ndarray, floors: np.ndarray, h: float, scale: float, steps: int, grid: int, bins: int):
    """Centre and covariance of the better of the two starts."""
    def quartile(q: float) -> np.ndarray:
        cells = np.sort(np.floor(np.abs(x) * grid + 0.5) * np.sign(x), axis=0)
        return cells[max(int(np.ceil(q * len(x))), 1) - 1] / grid

    best = None
    for start in range(2):
        mu = quartile(0.5)
        var = ((quartile(0.75) - quartile(0.25)) / 1.349) ** 2 if start == 0 else np.zeros(x.shape[1])
        cov = np.diag(var + floors ** 2)
        for _ in range(steps):
            d = np.einsum("ij,jk,ik->i", x - mu, np.linalg.inv(cov), x - mu)
            cell = np.floor(np.log(d + 1e-6) * bins)
            before = np.array([(cell < c).sum() for c in cell])
            inner = x[before < h * len(x)]
            mu = inner.mean(axis=0)
            cov = (inner.T @ inner / len(inner) - np.outer(mu, mu)) * scale + np.diag(floors ** 2)
        det = np.linalg.slogdet(cov)[1]
        if best is None or det < best[0]:
            best = det, mu, cov
    return best[1], best[2]


def whitened(vectors: list, most: int = 8):
    """(kept row numbers, n, deviations, whitened, explained) by numpy's own
    eigenvalues."""
    kept = [i for i, v in enumerate(vectors) if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(1024 * float(c))) + 100000 for c in vectors[i]] for i in kept])
    n, sums = len(kept), x.sum(axis=0)
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = x - sums / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-e)[:most]
    return kept, n, deviations, centred @ v[:, order] / np.sqrt(e[order]), e[order] / e.sum()


def drawn(docs: list[tuple], target: list, percent: int = 5, least: int = 20) -> set[tuple]:
    """(doc_id, n_features, weight, score, rank) of every document."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def buckets(text):
        w = word.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3)
                        for i in range(len(w) - k + 1)]
    features = [(i, *buckets(t)) for i, t in docs]
    s, t = Counter(b for _, _, bs in features for b in bs), Counter(b for x in target for b in buckets(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000))))
            for b in range(10000)]
    rows = []
    for i, n, bs in features:
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in bs)
        rows.append((i, n, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((-r[4], r[0]) for r in rows if r[1] >= least)
    rank = {i: k + 1 for k, (_, i) in enumerate(fit[:percent * len(fit) // 100])}
    return {(i, f, w, sc, rank.get(i)) for i, _, f, w, sc in rows}
