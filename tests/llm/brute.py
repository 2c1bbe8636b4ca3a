"""Plain Python forms of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def substring_dedup(rows, window):
    first = {}
    for i, text in rows:
        own = words(text)
        for j in range(len(own) - window + 1):
            key = tuple(own[j : j + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        own = words(text)
        gone = [False] * len(own)
        for j in range(len(own) - window + 1):
            if i is not None and first[tuple(own[j : j + window])] < i:
                gone[j : j + window] = [True] * window
        out.append((i, len(own), sum(gone), sha(" ".join(w for w, g in zip(own, gone, strict=True) if not g))))
    return out


def shingles(text, size=4):
    own = words(text, lower=True)
    if len(own) < size:
        return {tuple(own)} if own else set()
    return {tuple(own[j : j + size]) for j in range(len(own) - size + 1)}


class Union:
    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def ngram_join(rows, percent=85, size=4):
    sets = {i: shingles(t, size) for i, t in rows}
    union = Union(sets)
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                union.join(a, b)
    return {i: (len(s), union.find(i)) for i, s in sets.items()}


def held_out(i, modulus):
    return zlib.crc32(str(i).encode()) % modulus == 1


def katz(rows, discounts):
    import numpy as np

    tokens = {i: [*words(t, lower=True), "\0end"] for i, t in rows}
    train = [i for i in tokens if not held_out(i, 5)]
    one = Counter(w for i in train for w in tokens[i])
    two = Counter(p for i in train for p in zip(["\0begin", *tokens[i][:-1]], tokens[i], strict=True))
    total, types = sum(one.values()), len(one)

    def factors(counts):
        n = Counter(counts.values())
        return discounts(np.array([n[r] for r in range(1, 7)]))

    d1, d2 = factors(one), factors(two)
    cut = lambda c, d: c * (d[c] if c <= 5 else 1.0)
    scale = total if total - sum(cut(c, d1) for c in one.values()) > 1e-12 else total + 1
    p = {w: cut(c, d1) / scale for w, c in one.items()}
    unknown = 1 - sum(p.values())
    after = defaultdict(dict)
    for (v, w), c in two.items():
        after[v][w] = c
    alpha, below = {}, {}
    for v, own in after.items():
        n, kept = sum(own.values()), sum(cut(c, d2) for c in own.values())
        below[v] = n if n - kept > 1e-12 else n + 1
        alpha[v] = (below[v] - kept) / below[v] / (1 - sum(p[w] for w in own))
    # All words that were seen, and the unknown word, have probability one together.
    for v, own in list(after.items())[:20]:
        seen = sum(cut(c, d2) for c in own.values()) / below[v]
        assert abs(seen + alpha[v] * (unknown + sum(q for w, q in p.items() if w not in own)) - 1) < 1e-9
    out = {}
    for i, own in tokens.items():
        score = base = known = 0
        for v, w in zip(["\0begin", *own[:-1]], own, strict=True):
            c = one.get(w, 0)
            base += math.log10((c + 0.5) / (total + 0.5 * (types + 1)))
            known += c > 0
            q = cut(after[v][w], d2) / below[v] if w in after.get(v, {}) else alpha.get(v, 1.0) * p.get(w, unknown)
            score += math.log10(q)
        out[i] = (held_out(i, 5), len(own), known, total, base, score)
    return out


def near_vectors(rows, threshold=0.93):
    import numpy as np

    ok = lambda v: v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    good = {i: (label, np.array(v, dtype=float)) for i, v, label in rows if label is not None and ok(v)}
    union, links = Union([i for i, _, _ in rows]), Counter()
    for a, (la, x) in good.items():
        for b, (lb, y) in good.items():
            if a < b and la == lb and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                union.join(a, b)
                links[a] += 1
                links[b] += 1
    return {i: (links[i], union.find(i)) for i, _, _ in rows}


class Markov:
    """Interpolated counts of bytes after contexts, by recursion; the end is ``None``."""

    def __init__(self, texts, order):
        self.order, self.seen = order, defaultdict(Counter)
        for text in texts:
            own = text.encode()
            for i, symbol in enumerate([*own, None]):
                for k in range(order + 1):
                    self.seen[self.context(own[:i], k)][symbol] += 1

    @staticmethod
    def context(before, k):
        """The last ``k`` bytes and how many of them lie before the text."""
        return before[len(before) - k :] if k <= len(before) else (before, k - len(before))

    def p(self, before, symbol, k=None):
        k = self.order if k is None else k
        if k < 0:
            return 1 / 257
        shorter, seen = self.p(before, symbol, k - 1), self.seen.get(self.context(before, k))
        return shorter if seen is None else (seen[symbol] + len(seen) * shorter) / (seen.total() + len(seen))

    def log_likelihood(self, text):
        own = text.encode()
        return sum(math.log(self.p(own[:i], symbol)) for i, symbol in enumerate([*own, None]))


class UrlJudge:
    """Verdicts of URLs without a rule: four fifths of each class (by hash) count, one fifth sets the threshold."""

    def __init__(self, accepted, rejected, order, sample):
        def hashed(url):
            value = xxhash.xxh64_intdigest(url.encode(), seed=42)
            return value - (value >> 63 << 64), url.encode()

        classes = [sorted(set(c), key=hashed)[:sample] for c in (accepted, rejected)]
        self.models = [Markov([u for i, u in enumerate(c) if i % 5], order) for c in classes]
        held = [[self.score(u) for u in c[::5]] for c in classes]
        marks = sorted({x for scores in held for x in scores})
        gaps = [(low + high) / 2 for low, high in zip(marks, marks[1:])]

        def error(cut):
            return sum(x < cut for x in held[0]) / len(held[0]) + sum(x >= cut for x in held[1]) / len(held[1])

        best = min(map(error, gaps), default=1)
        self.cut = 0.0 if not all(held) else next(g for g in gaps if error(g) == best) if best < 1 else marks[0]

    def score(self, url):
        if not url:
            return 0.0
        return (self.models[0].log_likelihood(url) - self.models[1].log_likelihood(url)) / (len(url.encode()) + 1)

    def __call__(self, url):
        return "allow" if self.score(url) >= self.cut else "block"
