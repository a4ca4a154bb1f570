"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, size=3):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def smallest_reachable(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def jaccard_components(docs, size=3, num=90, den=100):
    """{doc_id: (n, component)} of [(doc_id, text)]."""
    sets = {i: shingles(t, size) for i, t in docs}
    ids = sorted(sets)
    links = []
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and den * len(x & y) >= num * len(x | y):
                links.append((a, b))
    of = smallest_reachable(ids, links)
    return {i: (len(sets[i]), of[i]) for i in ids}


def removed_repeats(docs, window=20):
    """{doc_id: (n_words, n_removed, sha of kept)} of [(doc_id, text)], ids distinct."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        w = words(text)
        covered = [False] * len(w)
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            if key in seen:
                covered[s : s + window] = [True] * window
            seen.add(key)
        kept = " ".join(x for x, c in zip(w, covered) if not c)
        out[i] = (len(w), sum(covered), hashlib.sha256(kept.encode()).hexdigest())
    return out


def base_measures(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def runs(w, least=6, times=4):
    """(start, length, period) of all maximal runs of a list of words."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            s = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, times * q):
                found.setdefault((s, i + q - s), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda x: (x[0], x[2]))


def with_cycle(doc_id, text):
    """Every tenth document by hash repeats a cycle of its own words."""
    w, h = words(text), zlib.crc32(str(doc_id).encode())
    if h % 10 or not w or doc_id is None:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def run_digest(w):
    """n_runs, the run of the greatest exponent and the digests of a list of words."""
    found = runs(w)
    best = min(found, key=lambda r: (Fraction(-r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (len(found), *first, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def hard_negatives(rows, asks, low=80, high=100, scale=256):
    """(anchor, positive, rank, negative, scores) of [(vec_id, vector, label)]."""

    def whole(v):
        return [math.floor(Fraction(x) * scale) for x in v]

    fine = [(i, whole(v), x) for i, v, x in rows if x is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    last = (1 << 63) - 1
    out = []
    for k, (a, v, x) in enumerate(fine):
        if a is None or not asks(a):
            continue
        scored = [(-sum(p * q for p, q in zip(v, u)), last if i is None else i, y == x, i) for j, (i, u, y) in enumerate(fine) if j != k and len(u) == len(v)]
        scored.sort(key=lambda s: s[:2])
        for s, _, _, pos in [s for s in scored if s[2]][:5]:
            fits = [t for t in scored if not t[2] and low * -s <= 100 * -t[0] <= high * -s][:5]
            out += [(a, pos, r + 1, t[3], -s, -t[0]) for r, t in enumerate(fits)]
    return sorted(out, key=repr)
