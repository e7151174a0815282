"""Brute-force versions of the operators, written plainly from the contracts."""

import math
import re
from collections import Counter, defaultdict

LOWER = {c: c + 32 for c in range(65, 91)}
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def clusters(texts: dict, k: int = 5, percent: int = 75) -> dict:
    """id -> (set size, component id)."""
    sets = {}
    for i, t in texts.items():
        w = SPACE_WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in texts}


def contamination(texts: dict, items: list, window: int = 13) -> dict:
    """id -> (words, hit words, item names)."""
    windows = defaultdict(set)
    for name, t in items:
        w = ALNUM_WORD.findall((t or "").translate(LOWER))
        k = min(window, len(w))
        for j in range(len(w) - k + 1) if w else ():
            windows[tuple(w[j : j + k])].add(name)
    sizes = {len(x) for x in windows}
    out = {}
    for i, t in texts.items():
        w = ALNUM_WORD.findall((t or "").translate(LOWER))
        hit, names = set(), set()
        for k in sizes:
            for j in range(len(w) - k + 1):
                if found := windows.get(tuple(w[j : j + k])):
                    hit |= set(range(j, j + k))
                    names |= found
        out[i] = (len(w), len(hit), sorted(names))
    return out


def repeats(rows: list, window: int) -> list:
    """For each (id, text) row: bytes, removed bytes, spans, what is left."""
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[j : j + window] for j in range(len(b) - window + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for j in range(len(b) - window + 1):
            if seen[b[j : j + window]] > 1:
                gone[j : j + window] = b"\1" * window
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def quality(text) -> tuple:
    """words, word characters, symbols, repeated lines, words in repeated windows."""
    t = text or ""
    w = SPACE_WORD.findall(t)
    lines = [x for x in t.split("\n") if SPACE_WORD.search(x)]
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(triples)
    covered = {p for i, x in enumerate(triples) if count[x] > 1 for p in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def language(known: list, texts: list) -> list:
    """(language, score) of each text, learned from (text, language) rows."""
    counts, grams = defaultdict(Counter), defaultdict(Counter)
    for text, lang in known:
        counts[lang].update(ALNUM_WORD.findall(text.translate(LOWER)))
    sizes = lambda p, i: range(1, min(5, len(p) - i) + 1)
    for lang, c in counts.items():
        for w, n in c.items():
            p = f"^{w}$"
            for i in range(len(p)):
                for s in sizes(p, i):
                    grams[p[i : i + s]][lang] += math.log1p(n)
    grams = {g: c for g, c in grams.items() if len(g) == 1 or sum(c.values()) >= 2}
    langs = sorted(counts)
    vocabulary = {w for c in counts.values() for w in c}
    total = {k: sum(counts[k].values()) for k in langs}
    by_size = {(k, s): 1 + sum(c[k] for g, c in grams.items() if len(g) == s) for k in langs for s in range(1, 6)}

    def word(w, k):
        if w in vocabulary:
            return math.log((counts[k][w] + 0.1) / (total[k] + 0.1 * len(vocabulary)))
        p, score = f"^{w}$", 0.0
        for i in range(len(p)):
            g = next((p[i : i + s] for s in reversed(sizes(p, i)) if p[i : i + s] in grams), None)
            score += math.log(((grams[g][k] if g else 0) + 0.1) / by_size[k, len(g) if g else 1])
        return score / len(p)

    out = []
    for text in texts:
        if not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        w = ALNUM_WORD.findall(text.translate(LOWER))
        z = {k: sum(word(x, k) for x in w) / math.sqrt(max(1, len(w))) for k in langs}
        top = max(z.values())
        share = {k: math.exp(v - top) for k, v in z.items()}
        best = max(langs, key=lambda k: (share[k], [-ord(c) for c in k]))
        out.append((best, share[best] / sum(share.values())))
    return out
