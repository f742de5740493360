"""Slow and plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def components(rows, n, num, den):
    """doc_id -> (set size, least id reachable)."""
    sets = {}
    for i, text in rows:
        words = (text or "").translate(LOWER).encode().split()
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} if words else set()
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    seen = defaultdict(list)
    for i in sets:
        shared = Counter(j for gram in sets[i] for j in seen[gram])
        for j, common in shared.items():
            if den * common >= num * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
        for gram in sets[i]:
            seen[gram].append(i)
    return {i: (len(sets[i]), find(i)) for i in sets}


def n_links(rows, n, num, den):
    """doc_id -> how many others its set links with."""
    out = Counter({i: 0 for i, _ in rows})
    for i, (a, text) in enumerate(rows):
        for b, other in rows[:i]:
            two = components([(0, text), (1, other)], n, num, den)
            if two[1][1] == 0:
                out.update((a, b))
    return dict(out)


def suffix_dedup(rows, window):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(r[s : s + window] for _, r in raw for s in range(len(r) - window + 1))
    out = []
    for i, r in raw:
        gone = bytearray(len(r))
        for s in range(len(r) - window + 1):
            if seen[r[s : s + window]] > 1:
                gone[s : s + window] = b"\1" * window
        runs = sum(1 for k in range(len(r)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(r), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(r, gone) if not g)).hexdigest()))
    return out


def substring_dedup(rows, window):
    last = 1 << 63
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in words:
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, last), last - 1 if i is None else i)
    out = []
    for i, w in words:
        gone = bytearray(len(w))
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < (last - 1 if i is None else i):
                gone[s : s + window] = b"\1" * window
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return out


def votes(counts, weighed, rows, labels, neighbours, rank, sharpness):
    """Scores of counts by the nearest of the labelled rows, from a full decomposition and all cosines."""
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    counts, rows = counts.astype(float), rows.astype(float)
    idf = np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 1
    a, b = (unit(np.log1p(x) * idf) for x in (counts, rows))
    axes = np.linalg.svd(b, full_matrices=False)[2][:rank].T
    cosines = unit(a @ axes) @ unit(b @ axes).T
    out = []
    for line in cosines:
        near = sorted(range(len(rows)), key=lambda j: -line[j])[:neighbours]
        alike = [max(line[j], 0) ** sharpness * weighed[labels[j]] for j in near]
        out.append(sum(v for v, j in zip(alike, near) if labels[j]) / sum(alike))
    return out


def without_repeats(rows, window):
    """(key, text) -> what is kept of the texts; those that lose all are left out."""
    raw = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(r[s : s + window] for _, r in raw for s in range(len(r) - window + 1))
    out = {}
    for k, r in raw:
        gone = {x for s in range(len(r) - window + 1) if seen[r[s : s + window]] > 1 for x in range(s, s + window)}
        if len(gone) < len(r) or not r:
            out[k] = bytes(b for x, b in enumerate(r) if x not in gone).decode("utf-8", "ignore")
    return out


def mixed(rows, weights, share, cap):
    """The texts of the mix. rows: (key, source, text) in each source's stream order."""
    words = lambda t: re.findall("[^\x20\x09-\x0D]+", t or "")
    sizes = Counter()
    for _, source, text in rows:
        sizes[source] += len(words(text))
    names = sorted(sizes, key=lambda x: (x is None, x or ""))
    weight = {x: weights[i % len(weights)] for i, x in enumerate(names)}
    target, rest = {}, share * sum(sizes.values())
    while left := [x for x in names if x not in target]:
        level = rest / sum(weight[x] for x in left)
        full = [x for x in left if cap * sizes[x] <= weight[x] * level]
        target.update({x: cap * sizes[x] for x in full} if full else {x: weight[x] * level for x in left})
        rest -= sum(cap * sizes[x] for x in full)
    out, at = [], Counter()
    for key, source, text in rows:
        own = words(text)
        passes, part = divmod(math.floor(target[source] + 0.5), sizes[source]) if sizes[source] else (0, 0)
        out += [(key, text)] * (passes if own else 0)
        last = min(len(own), part - at[source])
        if last > 0:
            out.append((key, text if last == len(own) else " ".join(own[:last])))
        at[source] += len(own)
    return out


def packed(documents, window):
    """(id, start, length, crc32, tokens, window, offset) of documents (id, token ids): best fit, longest first."""
    pieces = []
    for key, ids in documents:
        for s in range(0, len(ids), window):
            part = ids[s : s + window]
            pieces.append((key, s, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)), len(ids)))
    rooms, out, used = [], [], 0
    for turn, piece in enumerate(sorted(pieces, key=lambda p: (-p[2], p[0] is not None, p[0] or 0, p[1], p[3], p[4]))):
        fits = [r for r in rooms if r[0] >= piece[2]]
        best = min(fits, key=lambda r: (r[0], -r[1])) if fits else (window, 0, used)
        if fits:
            rooms.remove(best)
        else:
            used += 1
        out.append((*piece, best[2], window - best[0]))
        if best[0] > piece[2]:
            rooms.append((best[0] - piece[2], turn, best[2]))
    return out
