"""Slow, plain versions of the operators' contracts that the tests hold them against."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np


def token_rows(docs, path, end_id):
    from tokenizers import Tokenizer

    tok, at, out = Tokenizer.from_file(path), 0, []
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, end_id]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def check_packing(rows, docs, path, end_id, capacity):
    """rows: (doc_id, piece, start, length, crc, sequence_id, offset); docs may repeat. Returns the number of sequences."""
    from tokenizers import Tokenizer

    tok, by_text = Tokenizer.from_file(path), {}
    want = Counter()
    for doc_id, text in docs:
        if text not in by_text:
            ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
            first = len(ids) % capacity or capacity if len(ids) > capacity else len(ids)
            cuts = [0, *range(first, len(ids) + 1, capacity)]
            by_text[text] = [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        want.update((doc_id, *piece) for piece in by_text[text])
    assert Counter(tuple(r[:5]) for r in rows) == want
    spans = defaultdict(list)
    for r in rows:
        spans[r[5]].append((r[6], r[3]))
    for s in spans.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= capacity
    return len(spans)


def best_minimax(sizes, shards):
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid, n, at = (lo + hi) // 2, 1, 0
        for s in sizes:
            if at + s > mid:
                n, at = n + 1, 0
            at += s
        lo, hi = (lo, mid) if n <= shards else (mid + 1, hi)
    return lo


def removed_spans(docs, width=50):
    """doc_id → (n_bytes, n_removed, n_spans, sha256 of what stays)."""
    first = {}
    for doc_id, text in docs:
        b = (text or "").encode()
        for p in range(len(b) - width + 1):
            s = b[p : p + width]
            first[s] = min(first.get(s, doc_id), doc_id)
    out = {}
    for doc_id, text in docs:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if first[b[p : p + width]] < doc_id:
                gone[p : p + width] = b"\1" * width
        out[doc_id] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(docs, n, percent):
    """doc_id → (set size, smallest doc_id reachable)."""
    sets = [(d, shingles(t, n)) for d, t in docs]
    parent = {d: d for d, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(set)
    for k, (_, s) in enumerate(sets):
        for x in s:
            index[x].add(k)
    for k, (d, s) in enumerate(sets):
        shared = Counter(j for x in s for j in index[x] if j < k)
        for j, both in shared.items():
            if 100 * both >= percent * (len(s) + len(sets[j][1]) - both):
                a, b = root(d), root(sets[j][0])
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets}


def base_scores(docs):
    """doc_id → (held_out, n_tokens, n_known, train_tokens, base_score)."""
    counts, held = Counter(), {}
    toks = {}
    for d, t in docs:
        held[d] = zlib.crc32(str(d).encode()) % 5 == 1
        toks[d] = [*(t or "").encode().lower().split(), b" end"]
        if not held[d]:
            counts.update(toks[d])
    n, v = sum(counts.values()), len(counts)
    return {d: (held[d], len(x), sum(counts[w] > 0 for w in x), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)) for d, x in toks.items()}


def tiling(item, doc, min_match):
    """Words of `item` that tiles cover, each tile the longest common run of free words (first in item, then doc)."""
    names = {w: k for k, w in enumerate(dict.fromkeys([*item, *doc]))}
    a, b = (np.array([names[w] for w in x], np.int64) for x in (item, doc))
    free_a, free_b, covered = np.ones(len(a), bool), np.ones(len(b), bool), 0
    while True:
        best, run = (0, 0, 0), np.zeros(len(b) + 1, np.int64)
        for i in range(len(a)):  # run[j + 1]: the longest common run that ends at i and j
            run[1:] = np.where((b == a[i]) & free_b & free_a[i], run[:-1] + 1, 0)
            n = int(run.max())
            if n > best[0] or (n == best[0] and n and i - n + 1 < best[1]):
                best = (n, i - n + 1, int(np.flatnonzero(run == n)[0]) - n)
        n, i, j = best
        if n < min_match:
            return covered
        free_a[i : i + n] = False
        free_b[j : j + n] = False
        covered += n


def contaminated(docs, items, min_match=3, coverage=0.8):
    """(doc_id, item_id, words of the item, covered words)."""
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    out = []
    for d, text in docs:
        a = words(text)
        for k, item in items:
            b = words(item)
            if b and len(set(a) & set(b)) >= 0.5 * len(set(b)):
                got = tiling(b, a, min(min_match, len(b)))
                if got >= math.ceil(coverage * len(b) - 1e-9):
                    out.append((d, k, len(b), got))
    return out
