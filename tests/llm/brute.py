"""Plain, quadratic or single-process versions of the operators' contracts, for small tables."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def spans_removed(docs, size=50):
    """doc index -> (kept bytes, number of spans, removed bytes); docs are (id, text)."""
    data = [(i, (t or "").encode()) for i, t in docs]
    least = {}
    for i, b in data:
        for p in range(len(b) - size + 1):
            w = b[p:p + size]
            if i is not None and (w not in least or i < least[w]):
                least[w] = i
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - size + 1):
            first = least.get(b[p:p + size])
            if first is not None and (i is None or first < i):
                gone[p:p + size] = b"\x01" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((kept, spans, sum(gone)))
    return out


def shingle_set(text, size=5):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def jaccard_components(docs):
    """[(n_shingles, component id)] in order of docs (id, text)."""
    sets = [shingle_set(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    having = {}
    for i, s in enumerate(sets):
        for x in s:
            having.setdefault(x, []).append(i)
    tried = set()
    for rows in having.values():
        for a in rows:
            for b in rows:
                if a < b and (a, b) not in tried:
                    tried.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                        up[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = root(i)
        if d is not None and (least.get(r) is None or d < least[r]):
            least[r] = d
    return [(len(sets[i]), least.get(root(i))) for i in range(len(docs))]


def contamination(docs, items, size=10):
    """[(n_words, n_hit, item ids)] in order of docs (id, text); items are (item id, text)."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    cut = lambda t: word.findall((t or "").translate(ASCII_LOWER))
    grams = {}
    for item, text in items:
        w = cut(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[i:i + n]), set()).add("null" if item is None else str(item))
    sizes = {len(g) for g in grams}
    out = []
    for _, text in docs:
        w, hit, by = cut(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit.update(range(i, i + n))
                    by |= grams[tuple(w[i:i + n])]
        out.append((len(w), len(hit), sorted(by)))
    return out


def next_texts(docs):
    """The text after each document by descending id (the first after the last), for distinct ids."""
    order = sorted(range(len(docs)), key=lambda i: -docs[i][0])
    follow = {order[k]: order[(k + 1) % len(order)] for k in range(len(order))}
    return [docs[follow[i]][1] or "" for i in range(len(docs))]


def sha256(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
