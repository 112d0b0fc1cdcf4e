"""Plain reference versions of the training-data operators, for small inputs."""

import collections
import hashlib
import math
import re
import zlib

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def simhash(text, size=3):
    w = WORD.findall(low(text))
    if not w:
        return 0
    grams = [" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] or [" ".join(w)]
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(marked, bits=2):
    """{fingerprint: smallest id reachable} from [(id, fingerprint)]."""
    every = sorted({f for _, f in marked})
    root = {f: f for f in every}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(every):
        for b in every[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    least = {}
    for d, f in marked:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return {f: least.get(find(f)) for f in every}


def base_counts(text):
    text = text or ""
    w = WORD.findall(text)
    times = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    again = {k for i in range(len(w) - 7) if times[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again),
            n < 20 or 100 * len(again) > 30 * n)


def targets(sizes, weights=(1, 2, 3), most=3):
    """{source: target} by sharing the excess again until none is above its stop."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = {s for s in free if share[s] > most * sizes[s]}
        if not above:
            return {**share, **{s: float(most * sizes[s]) for s in capped}}
        capped |= above


def lm_scores(docs):
    """[(id, text)] -> [(id, held, n, known, N, base, score)] of the bigram model."""
    rows = [(d, WORD.findall(low(t)) + ["\n"], zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1) for d, t in docs]
    uni, bi = collections.Counter(), collections.Counter()
    for _, t, held in rows:
        if not held:
            uni.update(t)
            bi.update(zip(["\r"] + t[:-1], t))

    def discount(counts):
        n = [0] + [sum(x == k for x in counts) for k in (1, 2, 3, 4)]
        if not all(n[1:]):
            return [0, 0.5, 1.0, 1.5]
        y = n[1] / (n[1] + 2 * n[2])
        raw = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]]
        return [0] + [min(max(x, 0.01), k + 0.99) for k, x in enumerate(raw)]

    high, places = discount(list(bi.values())), collections.Counter(w for _, w in bi)
    small = discount(list(places.values()))
    types, vocabulary, total = len(bi), len(uni), sum(uni.values())
    context = collections.defaultdict(lambda: [0, 0, 0, 0])
    for (v, _), n in bi.items():
        context[v][0] += n
        context[v][min(n, 3)] += 1
    rest = sum(small[min(x, 3)] for x in places.values()) / types if types else 1.0

    def p(v, w):
        one = max(places[w] - small[min(places[w], 3)], 0) / max(types, 1) + rest / (vocabulary + 1)
        if v not in context:
            return one
        c = context[v]
        return (max(bi[v, w] - high[min(bi[v, w], 3)], 0) + sum(high[i] * c[i] for i in (1, 2, 3)) * one) / c[0]

    return [(d, held, len(t), sum(uni[x] > 0 for x in t), total,
             sum(math.log10((uni[x] + 0.5) / (total + 0.5 * (vocabulary + 1))) for x in t),
             sum(math.log10(p(v, w)) for v, w in zip(["\r"] + t[:-1], t))) for d, t, held in rows]


def bytes_removed(texts, length):
    """[(n, removed, spans, sha256)] per text."""
    data = [(t or "").encode() for t in texts]
    times = collections.Counter(x[i:i + length] for x in data for i in range(len(x) - length + 1))
    out = []
    for x in data:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if times[x[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(x, gone) if not g)
        out.append((len(x), sum(gone), len([r for r in bytes(gone).split(b"\0") if r]), hashlib.sha256(kept).hexdigest()))
    return out


def words_removed(docs, window):
    """{(id, text): (n, removed, sha256)}; equal (id, text) rows are one document."""
    order = sorted(set(docs), key=lambda r: (r[0] is None, r[0] or 0,
                                             xxhash.xxh3_64_intdigest((r[1] or "").encode(), 11) >> 1))
    seen, out = set(), {}
    for d, t in order:
        w = WORD.findall(t or "")
        gone = bytearray(len(w))
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if key in seen:
                gone[i:i + window] = b"\1" * window
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[d, t] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def window_matches(docs, items, size=5):
    """{(document, item): best weighted similarity} over every item-sized window, cut at the document's ends."""
    grams = lambda w: [tuple(w[i:i + size]) for i in range(len(w) - size + 1)]
    best = {}
    for d, doc in enumerate(docs):
        for i, item in enumerate(items):
            have, want = grams(doc), collections.Counter(grams(item))
            n = want.total()
            for start in range(1 - n, len(have)):
                cut = collections.Counter(have[max(start, 0):start + n])
                both = (cut & want).total()
                best[d, i] = max(best.get((d, i), 0.0), both / (cut.total() + n - both))
    return best
