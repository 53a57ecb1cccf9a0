"""Plain versions of the operators on Python lists, for comparison."""

from __future__ import annotations

import re
from hashlib import sha256

import numpy as np


def groups(ids, links):
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def shingles(text, k):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = data.split()
    if not words:
        return set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} or {tuple(words)}


def near_duplicates(docs, k, percent):
    sets = {d: shingles(t, k) for d, t in docs}
    links = []
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * len(sets[a] | sets[b]):
                    links.append((a, b))
    return {d: (len(sets[d]), c) for d, c in groups(sets, links).items()}


def without_repeats(docs, length=100):
    seen, out = set(), {}
    for d, text in sorted(docs, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, np.int64)
        for i in range(len(data) - length + 1):
            piece = data[i : i + length]
            if piece in seen:
                gone[i] += 1
                gone[i + length] -= 1
            seen.add(piece)
        mask = np.cumsum(gone)[: len(data)] > 0
        kept = bytes(np.frombuffer(data, np.uint8)[~mask])
        spans = int((np.diff(np.concatenate(([0], mask.astype(np.int8)))) == 1).sum())
        out[d] = (len(data), int(mask.sum()), spans, sha256(kept).hexdigest())
    return out


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def leaks(docs, items, masks, least, span):
    """(doc, item) of every aligned run with a seed hit whose best segment (1 for equal, -4 for different) is long."""
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    found = set()
    for d, text in docs:
        own = words(text)
        for i, item in items:
            other = words(item)
            tried = [*masks, *(["1" * len(other)] if 0 < len(other) < span else [])]
            for mask in tried:
                for p in range(len(own) - len(mask) + 1):
                    for q in range(len(other) - len(mask) + 1):
                        if all(own[p + k] == other[q + k] for k, c in enumerate(mask) if c == "1"):
                            start = max(0, q - p), max(0, p - q)
                            same = [a == b for a, b in zip(other[start[0] :], own[start[1] :])]
                            best = 0
                            score = hits = top = 0
                            for s in same:
                                score, hits = (score, hits) if score > 0 else (0, 0)
                                score, hits = score + (1 if s else -4), hits + s
                                if score > top:
                                    top, best = score, hits
                            if best >= min(least, len(other)):
                                found.add((d, i))
    return found


BASE = (
    ("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", r"AKIA[A-Z0-9]+"),
    ("hex", r"[0-9a-f]+"),
)


def base_spans(text):
    rows = []
    for k, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            size = len(m[2]) if kind == "assign" else len(m[0])
            if size >= (6, 20, 24)[k]:
                rows.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [r[2] for r in sorted(rows)]
