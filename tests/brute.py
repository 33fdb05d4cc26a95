"""Plain-Python brute-force versions of the pinned contracts, for small fixtures."""

import hashlib
import math
import re

import numpy as np

WS = re.compile(r"[ \t\n\x0b\f\r]+")
SENT = re.compile(r"(?<=[.!?])[ \t\n\x0b\f\r]+")


def tokens(text):
    return [t for t in WS.split(text) if t]


def cosine(a, b):
    dot = 0.0
    for x, y in zip(a, b):
        dot += float(x) * float(y)
    na = math.sqrt(sum(float(x) * float(x) for x in a))
    nb = math.sqrt(sum(float(y) * float(y) for y in b))
    return None if na * nb == 0 else dot / (na * nb)


def dotp(a, b):
    s = 0.0
    for x, y in zip(a, b):
        s += float(x) * float(y)
    return s


def ranking(points, query, k, metric="cosine", where=lambda p: True):
    """points: list of dicts with id, vector. -> [(rank, id, score)]"""
    scored = []
    for p in points:
        if not where(p) or p["vector"] is None or len(p["vector"]) != len(query):
            continue
        s = cosine(p["vector"], query) if metric == "cosine" else dotp(p["vector"], query)
        if s is None:
            continue
        scored.append((round(s, 6), p["id"]))
    scored.sort(key=lambda t: (-t[0], t[1]))
    return [(i + 1, pid, s) for i, (s, pid) in enumerate(scored[:k])]


def fixed_chunks(text, size):
    t = tokens(text)
    return [" ".join(t[i:i + size]) for i in range(0, len(t), size)]


def units(text, size):
    out = []
    for s in SENT.split(text):
        toks = tokens(s)
        for i in range(0, len(toks), size):
            out.append(toks[i:i + size])
    return out


def sentence_chunks(text, size, overlap=40):
    u = units(text, size)
    chunks, start, total = [], 0, 0
    for i, unit in enumerate(u):
        c = len(unit)
        if total + c <= size:
            total += c
            continue
        chunks.append((start, i))
        lim = min(overlap, size - c)
        j, r = i, 0
        while j - 1 > start and r + len(u[j - 1]) <= lim:
            j -= 1
            r += len(u[j])
        start, total = j, r + c
    if u:
        chunks.append((start, len(u)))
    return [" ".join(t for x in u[s:e] for t in x) for s, e in chunks]


def hash_vec(toks, dim=256):
    v = np.zeros(dim)
    for t in toks:
        h = int(hashlib.md5(t.lower().encode()).hexdigest()[:8], 16)
        v[h % dim] += 1 - 2 * ((h // dim) % 2)
    return v


def semantic_chunks(text, dim=256, pct=0.95):
    sents = [tokens(s) for s in SENT.split(text)]
    sents = [s for s in sents if s]
    m = len(sents)
    if m == 0:
        return []
    S = [hash_vec(s, dim) for s in sents]
    W = [sum(S[j] for j in range(max(0, i - 1), min(m, i + 2))) for i in range(m)]
    d = []
    for i in range(m - 1):
        na, nb = math.sqrt(float(W[i] @ W[i])), math.sqrt(float(W[i + 1] @ W[i + 1]))
        d.append(None if na * nb == 0 else round(1.0 - float(W[i] @ W[i + 1]) / (na * nb), 6))
    vals = [x for x in d if x is not None]
    thr = round(float(np.percentile(vals, pct * 100)), 6) if vals else None
    chunks, cur = [], []
    for i in range(m):
        cur.extend(sents[i])
        if i < m - 1 and thr is not None and d[i] is not None and d[i] > thr:
            chunks.append(" ".join(cur))
            cur = []
    chunks.append(" ".join(cur))
    return chunks
