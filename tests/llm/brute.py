"""Plain versions of the operators, for comparison."""

import hashlib
import re
from collections import Counter

import numpy as np
import xxhash

SF = "/root/testdata/sf0.001"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def bench_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))


def plain_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))


def fingerprint(t, shingle=3):
    w = plain_words(t)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + shingle]).encode(), 42) for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in h) > len(h))


def components(nodes, linked):
    """Smallest reachable index of each node by depth-first search."""
    out = {}
    for i in range(len(nodes)):
        if i in out:
            continue
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in out:
                out[j] = i
                todo += [k for k in range(len(nodes)) if k not in out and linked(nodes[j], nodes[k])]
    return [out[i] for i in range(len(nodes))]


def contamination(docs, items, window=13):
    owners = {}
    for item, t in items:
        w = bench_words(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            owners.setdefault(tuple(w[k:k + window]), set()).add(item)
    sizes = {len(w) for w in owners}
    out = []
    for t in docs:
        w = bench_words(t)
        hit, found = [False] * len(w), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in owners:
                    hit[k:k + n] = [True] * n
                    found |= owners[tuple(w[k:k + n])]
        names = sorted(str(x) for x in found if x is not None)
        n = sum(hit)
        out.append((len(w), n, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), n > 0 and 20 * n >= len(w)))
    return out


def without_repeats(texts, length=200):
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    data = [(t or "").encode() for t in texts]
    c = Counter(b[k:k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if c[b[k:k + length]] > 1:
                gone[k:k + length] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return out


def sha(b):
    return hashlib.sha256(b).hexdigest()
