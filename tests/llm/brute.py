"""Plain versions of the contracts, one document at a time, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = " \t\n\r\x0b\x0c"
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def repetition_base(text):
    text = text or ""
    own = words(text)
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if words(line):
            duplicates += line in seen
            seen.add(line)
    grams = Counter(tuple(own[i : i + 5]) for i in range(len(own) - 4))
    inside = set()
    for i in range(len(own) - 4):
        if grams[tuple(own[i : i + 5])] > 1:
            inside.update(range(i, i + 5))
    failed = len(own) < 10 or 100 * len(inside) > 20 * len(own)
    return len(own), sum(map(len, own)), sum(text.count(c) for c in "#*$%&|<>"), duplicates, len(inside), failed


def repeated_share(text, n):
    """Share of the words' characters in n-grams seen earlier in the text."""
    own = words(text)
    seen, inside = set(), set()
    for i in range(len(own) - n + 1):
        gram = tuple(own[i : i + n])
        if gram in seen:
            inside.update(range(i, i + n))
        seen.add(gram)
    size = sum(map(len, own))
    return sum(len(own[i]) for i in inside) / size if size else 0.0


def shingles(text, length):
    own = words(text)
    if not own:
        return set()
    return {tuple(own[i : i + length]) for i in range(max(1, len(own) - length + 1))}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(documents):
    """(doc_id, text) sorted by doc_id -> [(doc_id, text, edited text, next text)]."""
    ordered = sorted(set(documents))
    out = []
    for i, (doc_id, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1] or ""
        text = text or ""
        cut = len(text) // 4
        out.append((doc_id, text, text[: len(text) - cut] + following[:cut], following))
    return out


def linked(documents, percent=85, length=4):
    """doc_id -> (set size of the row, component)."""
    sets = [(d, shingles((t or "").translate(CAPITALS), length)) for d, t in documents]
    parent = {d: d for d, _ in sets if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, one) in enumerate(sets):
        for b, two in sets[:i]:
            if a is None or b is None or not one or not two:
                continue
            if 100 * len(one & two) >= percent * len(one | two):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [(d, len(s), None if d is None else find(d)) for d, s in sets]


def line_dedup(documents):
    def key(line):
        return line.strip(SPACES).translate(CAPITALS)

    holders = defaultdict(set)
    for d, text in documents:
        if d is not None:
            for line in (text or "").split("\n"):
                holders[key(line)].add(d)
    out = []
    for d, text in documents:
        lines = (text or "").split("\n")
        kept = [
            line
            for line in lines
            if d is None or len(key(line)) < 10 or len(holders[key(line)]) < 2 or min(holders[key(line)]) == d
        ]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept).encode())))
    return out


def substring_dedup(documents, window=50):
    first = {}
    for d, text in documents:
        own = words(text)
        for i in range(len(own) - window + 1):
            gram = tuple(own[i : i + window])
            if d is not None:
                first[gram] = min(first.get(gram, d), d)
    out = []
    for d, text in documents:
        own = words(text)
        gone = set()
        for i in range(len(own) - window + 1):
            if d is not None and first[tuple(own[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = [w for i, w in enumerate(own) if i not in gone]
        out.append((d, len(own), len(gone), sha(" ".join(kept).encode())))
    return out


def targets(sizes, weights=(5, 2, 1), share=1.5, limit=2):
    """source -> words -> target, by resharing until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        rest = total - sum(fixed.values())
        own = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if own[s] >= limit * sizes[s]]
        if not above:
            return {**fixed, **own}
        fixed.update({s: float(limit * sizes[s]) for s in above})
        if len(fixed) == len(names):
            return fixed


def highest_quotients(votes, seats):
    """party -> seats by repeatedly giving one to the largest votes / (2 seats + 1), ties to the first name."""
    won = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = min(votes, key=lambda p: (-votes[p] / (2 * won[p] + 1), p))
        won[best] += 1
    return won
