"""Plain Python versions of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def windows_removed(rows, width=13):
    """rows (id, text) -> [(id, n_words, n_removed, sha)]"""
    big = float("inf")
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            first[key] = min(first.get(key, big), big if i is None else i)
    out = []
    for i, t in rows:
        w = words(t)
        own = big if i is None else i
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < own:
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def bytes_removed(rows, length=200):
    """rows (id, text) -> [(id, n_bytes, n_removed, n_spans, sha)]"""
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k:k + length] for _, b in data for k in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def rule_statistics(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    covered = {j for k in range(len(w) - 4) if seen[tuple(w[k:k + 5])] > 1 for j in range(k, k + 5)}
    stats = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
    return stats, len(w) < 10 or 100 * len(covered) > 20 * len(w)


def fingerprint(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(t)
    grams = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) > 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def linked(prints, bits=2):
    """prints -> {print: root}, by comparing all pairs"""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    known = sorted(root)
    for a in known:
        for b in known:
            if a < b and (a ^ b).bit_count() <= bits:
                root[find(b)] = find(a)
    return {p: find(p) for p in known}


def simhash_rows(rows):
    prints = [fingerprint(t) for _, t in rows]
    root = linked(prints)
    best = defaultdict(list)
    for (i, _), p in zip(rows, prints):
        best[root[p]].append((i is None, i))
    return [(i, f"{p:016x}", min(best[root[p]], key=lambda x: (x[0], x[1] if x[1] is not None else 0))[1])
            for (i, _), p in zip(rows, prints)]


def exact_rows(rows):
    """rows (id, text) -> [(id, keep_id, size, kept, sha)]; repeated (id, text): one kept"""
    groups = defaultdict(list)
    for n, (i, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i, n))
    best = {k: min(v, key=lambda x: (x[0], x[1], x[2] or 0)) for k, v in groups.items()}
    out = []
    for n, (i, t) in enumerate(rows):
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        b = best[norm]
        out.append((i, b[2], len(groups[norm]), b[3] == n, sha(norm)))
    return out


def lines_removed(rows, width):
    """rows (id, text) -> [(id, n_lines, n_removed, kept text)]; windows without a
    word do not count"""
    first = {}
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0, n))
    for n in order:
        lines = (rows[n][1] or "").split("\n")
        for k in range(len(lines) - width + 1):
            first.setdefault(tuple(lines[k:k + width]), (n, k))
    out = []
    for n, (i, t) in enumerate(rows):
        lines = (t or "").split("\n")
        gone = set()
        for k in range(len(lines) - width + 1):
            own = tuple(lines[k:k + width])
            if first[own] != (n, k) and words(" ".join(own)):
                gone.update(range(k, k + width))
        out.append((i, len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone)))
    return out
