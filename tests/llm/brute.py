"""Plain single-process versions that the operators are compared with."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def shingles(text, k=5):
    w = WORD.findall(ascii_lower(text or ""))
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))}


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_components(docs):
    """{doc_id: (n_shingles, component)} by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in docs}
    by, links, seen = {}, [], set()
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    for ids in by.values():
        for p, a in enumerate(ids):
            for b in ids[p + 1:]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    n = len(sets[a] & sets[b])
                    if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                        links.append((a, b))
    comp = components(sets, links)
    return {i: (len(sets[i]), comp[i]) for i in sets}


def substring_dedup(docs, length=200):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}"""
    from collections import Counter
    from hashlib import sha256

    raw = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(hash(b[p:p + length]) for _, b in raw for p in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        edge = 0
        for p in range(len(b) - length + 1):
            if seen[hash(b[p:p + length])] > 1:
                a = max(p, edge)
                edge = p + length
                gone[a:edge] = b"\1" * (edge - a)
        runs = sum(1 for p in range(len(b)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(b), sum(gone), runs, sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return out


def vector_links(rows, threshold=0.93):
    """{vec_id: (n_links, component)} of (vec_id, embedding, label) rows."""
    import numpy as np

    ok = {}
    for i, v, g in rows:
        x = np.array([np.nan if c is None else c for c in (v or [])], float)
        if g is not None and len(x) and np.isfinite(x).all() and np.linalg.norm(x) > 0:
            ok.setdefault((g, len(x)), []).append((i, x / np.linalg.norm(x)))
    n, links = {i: 0 for i, _, _ in rows}, []
    for group in ok.values():
        ids, x = [i for i, _ in group], np.stack([v for _, v in group])
        hit = x @ x.T >= threshold
        np.fill_diagonal(hit, False)
        for p, q in zip(*np.nonzero(hit)):
            n[ids[p]] += 1
            links.append((ids[p], ids[q]))
    comp = components(n, links)
    return {i: (n[i], comp[i]) for i in n}
