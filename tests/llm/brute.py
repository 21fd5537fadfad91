"""Brute-force versions of the operators, for small inputs."""

import hashlib
import re
import string
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def smallest(items, linked):
    """Smallest reachable item per item, over the pairs `linked`."""
    parent = {i: i for i in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def ngram_rows(rows):
    sets = [shingles(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    groups = smallest(range(len(rows)), links)
    low = defaultdict(list)
    for i, g in groups.items():
        if rows[i][0] is not None:
            low[g].append(rows[i][0])
    return [(rows[i][0], len(sets[i]), (min(low[groups[i]], default=None) if sets[i] else rows[i][0]))
            for i in range(len(rows))]


def suffix_rows(rows, window=200):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p:p + window] for _, b in raw for p in range(len(b) - window + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - window + 1):
            if seen[b[p:p + window]] > 1:
                gone[p:p + window] = b"\1" * window
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def phrase_rows(rows, window=13):
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            if i is not None:
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p:p + window])] < i:
                gone[p:p + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def shard_of(doc_id, shards):
    import math
    draws = []
    for s in range(shards):
        key = "\0null" if doc_id is None else str(doc_id)
        x = int(hashlib.md5(f"{key}#{s}".encode()).hexdigest()[:13], 16)
        draws.append((-math.log((x + 0.5) / 2 ** 52), s))
    return min(draws)[1]


def crc(text):
    return zlib.crc32((text or "").encode())
