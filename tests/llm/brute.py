"""Plain-Python statements of what the operators compute, for small tables."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import xxhash

LICENSES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def exact_groups(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(low(text), []).append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[low(text)]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, sha256(low(text).encode()).hexdigest()))
    return out


def fingerprint(text):
    w = words(low(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    counts = [0] * 64
    for shingle in shingles:
        h = xxhash.xxh64_intdigest(shingle.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def near_groups(rows):
    fps = [fingerprint(text) for _, text in rows]
    n = len(rows)
    root = roots(
        n,
        [(i, j) for i in range(n) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2],
    )
    smallest = {}
    for (doc_id, _), r in zip(rows, root, strict=True):
        if doc_id is not None:
            smallest[r] = min(doc_id, smallest.get(r, doc_id))
    return [
        (doc_id, f"{fp:016x}", smallest.get(r))
        for (doc_id, _), fp, r in zip(rows, fps, root, strict=True)
    ]


def licenses(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))
    starts, labels = [], set()
    for phrase, label in LICENSES:
        q = phrase.split()
        found = [i for i in range(len(w) - len(q) + 1) if w[i : i + len(q)] == q]
        starts += found
        labels |= {label} if found else set()
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(
        sorted(labels)
    )


def mix_targets(rows):
    """source -> (size, target) of rows (source, text)."""
    sizes = Counter()
    for source, text in rows:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in stopped)
        left = sum(weight[s] for s in order if s not in stopped)
        target = {
            s: 3 * sizes[s] if s in stopped else rest * weight[s] / left for s in order
        }
        more = {s for s in order if s not in stopped and target[s] > 3 * sizes[s]}
        if not more:
            return {s: (sizes[s], target[s]) for s in order}
        stopped |= more


def kneser_ney(rows):
    """(n_tokens, n_known, N, base, score) of rows (doc_id, text)."""
    tokens = [words(low(text)) + [None] for _, text in rows]
    unigrams, bigrams = Counter(), Counter()
    for (doc_id, _), t in zip(rows, tokens, strict=True):
        if crc(doc_id) % 10:
            unigrams.update(t)
            bigrams.update(zip(["<s>", *t[:-1]], t, strict=True))
    n, v = sum(unigrams.values()), len(unigrams)

    def discounts(counts):
        c = Counter(counts)
        out = [0.0]
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0
        for k in (1, 2, 3):
            d = k - (k + 1) * y * c[k + 1] / c[k] if c[k] and c[k + 1] and y else k / 2
            out.append(d if 0 < d <= k else k / 2)
        return out

    before = Counter(w for _, w in bigrams)
    total, followers = Counter(), {}
    for (context, _), k in bigrams.items():
        total[context] += k
        followers.setdefault(context, [0, 0, 0, 0])[min(k, 3)] += 1
    d2, d1, distinct = discounts(bigrams.values()), discounts(before.values()), len(bigrams)
    mass = sum(d1[min(k, 3)] for k in before.values()) / distinct if distinct else 1.0

    def lower(w):
        k = before[w]
        return (k - d1[min(k, 3)]) / max(distinct, 1) + mass / (v + 1)

    def p(context, w):
        if context not in total:
            return lower(w)
        k = bigrams.get((context, w), 0)
        left = sum(d2[i] * followers[context][i] for i in (1, 2, 3))
        return max(k - d2[min(k, 3)], 0) / total[context] + left / total[context] * lower(w)

    return [
        (
            len(t),
            sum(unigrams[w] > 0 for w in t),
            n,
            sum(math.log10((unigrams[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t),
            sum(math.log10(p(c, w)) for c, w in zip(["<s>", *t[:-1]], t, strict=True)),
        )
        for t in tokens
    ]


def near_vectors(rows, cosine=0.95):
    """(vec_id, n_links, component_id) of rows (vec_id, vector)."""

    def unit(v):
        if not v or any(x is None for x in v):
            return None
        v = np.array(v, float)
        if not np.isfinite(v).all() or not v.any():
            return None
        v = v / np.abs(v).max()
        return v / np.linalg.norm(v)

    units = [unit(v) for _, v in rows]
    n = len(rows)
    pairs = [
        (i, j)
        for i in range(n)
        for j in range(i)
        if units[i] is not None
        and units[j] is not None
        and len(units[i]) == len(units[j])
        and float(units[i] @ units[j]) >= cosine
    ]
    links = Counter(i for pair in pairs for i in pair)
    root = roots(n, pairs)
    smallest = {}
    for (vec_id, _), r in zip(rows, root, strict=True):
        smallest[r] = min(vec_id, smallest.get(r, vec_id))
    return [(vec_id, links[i], smallest[root[i]]) for i, (vec_id, _) in enumerate(rows)]
