"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def groups(docs, size=4, percent=85):
    """docs: (id, text) with different ids; id -> (set size, smallest id of the group)."""
    sets = {i: shingles(t, size) for i, t in docs}
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((top(a), top(b)))
                up[high] = low
    return {i: (len(sets[i]), top(i)) for i in ids}


def lines(docs, least=10):
    """docs: (id, text) with different ids; id -> (lines, dropped, kept text)."""
    key = lambda line: line.strip(SPACES).translate(LOWER)
    first = {}
    for i, text in sorted(docs):
        for line in (text or "").split("\n"):
            first.setdefault(key(line), i)
    out = {}
    for i, text in docs:
        split = (text or "").split("\n")
        kept = [x for x in split if len(key(x)) < least or first[key(x)] == i]
        out[i] = (len(split), len(split) - len(kept), "\n".join(kept))
    return out


def figures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    held = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + d for i, w in enumerate(windows) if w in often for d in range(3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(held) - len(set(held)), len(covered)


def edited(docs):
    """docs: (id, text) with different ids; id -> edited text."""
    order = sorted(docs, reverse=True)
    out = {}
    for (i, text), (_, following) in zip(order, [*order[1:], order[0]], strict=True):
        text, third = text or "", len(text or "") // 3
        out[i] = text[: len(text) - third] + (following or "")[:third]
    return out


def lz_phrases(text):
    data, phrases, start = text.encode(), set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in phrases:
            phrases.add(data[start:end])
            start = end
    return phrases


def pieces(ids, capacity=2048):
    """(piece, start, length, crc) of the ids of a document, its end included."""
    first = len(ids) % capacity or capacity
    starts = [0, *range(first, len(ids), capacity)]
    ends = [*starts[1:], len(ids)]
    return [(k, s, e - s, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[s:e]))) for k, (s, e) in enumerate(zip(starts, ends, strict=True))]


def exponent(totals, targets):
    """Bisection for the exponent of the weights."""

    def weights(x):
        powers = {s: t**x for s, t in totals.items()}
        return {s: p / sum(powers.values()) for s, p in powers.items()}

    def entropy(x):
        return -sum(w * math.log(w) for w in weights(x).values())

    def passes(x):
        w = weights(x)
        budget = max(totals[s] / w[s] for s in w) if targets.budget is None else targets.budget * sum(totals.values())
        return max(w[s] * budget / totals[s] for s in w)

    def bisect(good):
        low, high = 0.0, 1.0
        if good(high):
            return high
        if not good(low):
            return low
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if good(middle) else (low, middle)
        return low

    goal = targets.entropy * math.log(len(totals))
    x = max(bisect(lambda x: entropy(x) >= goal - 1e-12), bisect(lambda x: passes(x) > targets.most_passes * (1 + 1e-12)))
    return x, weights(x)


def components(edges):
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    out, seen = {}, set()
    for start in sorted(near):
        if start in seen:
            continue
        group, left = {start}, [start]
        while left:
            new = near[left.pop()] - group
            group |= new
            left += new
        seen |= group
        out |= dict.fromkeys(group, start)
    return out


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()
