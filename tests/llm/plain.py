"""Plain versions of the operators' rules, for comparison."""

import hashlib
import re
import zlib

import numpy as np
import xxhash


class Groups:
    """Union-find; the root of a group is its smallest member."""

    def __init__(self, n):
        self.up = list(range(n))

    def root(self, x):
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def simhash_components(rows, distance=4):
    """{doc_id: (fingerprint, component)} of (doc_id, text) rows."""
    prints = [simhash(t) for _, t in rows]
    groups = Groups(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                groups.join(i, j)
    members = {}
    for i, (d, _) in enumerate(rows):
        members.setdefault(groups.root(i), []).append(d)
    least = {r: min((d for d in m if d is not None), default=None) for r, m in members.items()}
    return [(d, f"{p:016x}", least[groups.root(i)]) for i, ((d, _), p) in enumerate(zip(rows, prints))]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        c = int(c)
        total += c if i % 2 == 0 else (2 * c - 9 if c > 4 else 2 * c)
    return total % 10 == 0


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v, d: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v, d: all(int(x) <= 255 for x in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v, d: 14 <= len(d) <= 19 and luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v, d: 10 <= len(d) <= 15),
]


def pii_base(text):
    """(counts, digest) of the base spans."""
    spans, counts = [], [0] * 4
    for place, (kind, pattern, valid) in enumerate(PII):
        for m in re.finditer(pattern, text or ""):
            if valid(m[0], re.sub("[^0-9]", "", m[0])):
                spans.append((m.start(), place, m.end(), kind))
                counts[place] += 1
    text = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
    return (*counts, hashlib.sha256(text.encode()).hexdigest())


def edit_distance_within(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        before, row = row, [i + 1]
        for j, b in enumerate(text):
            row.append(min(before[j] + (a != b), before[j + 1] + 1, row[j] + 1))
    return min(row)


def vector_links(rows, similarity=0.9):
    """{vec_id: (n_links, component)} of (vec_id, vector) rows."""
    def unit(v):
        if v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float)
        v = v / np.abs(v).max()
        return v / np.sqrt((v * v).sum())

    units = [unit(v) for _, v in rows]
    groups, n = Groups(len(rows)), [0] * len(rows)
    for i, a in enumerate(units):
        for j, b in enumerate(units[:i]):
            if a is not None and b is not None and len(a) == len(b) and float(a @ b) >= similarity:
                n[i] += 1
                n[j] += 1
                groups.join(i, j)
    ids = [r for r, _ in rows]
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            r = groups.root(i)
            least[r] = min(d, least.get(r, d))
    return [(d, n[i], least.get(groups.root(i))) for i, d in enumerate(ids)]


def crc_of_ids(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())
