"""Plain Python versions of what the operators compute."""

from __future__ import annotations

import string

import xxhash

BLANKS = " \t\n\x0b\f\r"
_TO_SPACE = str.maketrans(BLANKS, " " * len(BLANKS))
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text: str | None) -> list[str]:
    return [w for w in (text or "").translate(_TO_SPACE).split(" ") if w]


def lower(text: str | None) -> str:
    return (text or "").translate(_LOWER)


def shingles(found: list[str], size: int) -> list[str]:
    return [" ".join(found[n : n + size]) for n in range(max(1, len(found) - size + 1))] if found else []


def fingerprint(text: str | None, size: int) -> int:
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles(words(lower(text)), size)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


class Groups:
    """Union-find that keeps the smallest member as the root."""

    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0
