"""Plain-Python versions that the operators are held against."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bag(text: str | None, k: int = 5) -> Counter:
    w = WORD.findall(text or "")
    if 0 < len(w) < k:
        return Counter([tuple(w)])
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def jaccard(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - both
    return both / total if total else 0.0


def classes(ids, links) -> dict:
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {i: top(i) for i in root}


def near_classes(rows: list[tuple[int, str | None]], threshold: float = 0.8) -> dict:
    bags = {i: bag(t) for i, t in rows}
    return classes(bags, [(a, b) for a, b in combinations(sorted(bags), 2) if bags[a] and bags[b] and jaccard(bags[a], bags[b]) >= threshold])


def line_sets(text: str | None, k: int = 5) -> dict[int, frozenset]:
    out = {}
    for n, line in enumerate((text or "").split("\n")):
        w = WORD.findall(line)
        if w:  # fewer words than k are one token together
            out[n] = frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))
    return out


def kept_lines(rows: list[tuple[int, str | None]], threshold: float = 0.8) -> dict[int, list[int]]:
    """Lines that match no earlier line, by (id, line)."""
    lines = [(i, n, s) for i, t in sorted(rows) for n, s in line_sets(t).items()]
    by_token = defaultdict(list)
    kept = defaultdict(list)
    for at, (i, n, s) in enumerate(lines):
        near = {j for t in s for j in by_token[t]}
        if not any(len(s & lines[j][2]) >= threshold * len(s | lines[j][2]) - 1e-9 for j in near):
            kept[i].append(n)
        for t in s:
            by_token[t].append(at)
    return kept
