"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

from collections import defaultdict
from fractions import Fraction


def shingle_set(text: str | None, words: int) -> frozenset:
    found = (text or "").encode().lower().split()
    if not found:
        return frozenset()
    if len(found) < words:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def near_duplicates(rows, words: int, similarity: str) -> dict:
    """id -> (n_shingles, component, kept), comparing every pair."""
    least = Fraction(similarity)
    sets = {key: shingle_set(text, words) for key, text in rows}
    parent = {key: key for key in sets}

    def root(key):
        while parent[key] != key:
            parent[key] = parent[parent[key]]
            key = parent[key]
        return key

    holders = defaultdict(set)
    for key, found in sets.items():
        for shingle in found:
            holders[shingle].add(key)
    for key, found in sets.items():
        others = {other for shingle in found for other in holders[shingle] if other > key}
        for other in others:
            shared = len(found & sets[other])
            if shared >= least * (len(found) + len(sets[other]) - shared):
                a, b = sorted((root(key), root(other)))
                parent[b] = a
    return {key: (len(sets[key]), root(key), root(key) == key) for key in sets}
