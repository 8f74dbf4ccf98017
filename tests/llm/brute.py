"""Plain Python twins of the operators."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import xxhash


def kneser_ney(texts: list[bytes], order: int):
    """Log-probability of all units of a text, by dictionaries."""
    grams = Counter()
    for text in texts:
        padded = bytes(order - 1) + text.replace(b"\0", b"\1") + b"\0"
        for i in range(len(text) + 1):
            grams[padded[i : i + order]] += 1
    tables = {order: grams}
    for n in range(order - 1, 0, -1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])
    discounts, totals, spared = {}, {}, {}
    for n, table in tables.items():
        c = Counter(table.values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] and c[2] else 0.5
        d = []
        for i in (1, 2, 3):
            value = i - (i + 1) * y * c[i + 1] / c[i] if c[i] else i / 2
            d.append(min(max(value, 0.01 * i), float(i)))
        discounts[n] = d
        totals[n], spared[n] = Counter(), Counter()
        for g, v in table.items():
            totals[n][g[:-1]] += v
            spared[n][g[:-1]] += d[min(v, 3) - 1]

    def p(g: bytes) -> float:
        n = len(g)
        below = p(g[1:]) if n > 1 else 1 / 256
        total = totals[n].get(g[:-1], 0)
        if not total:
            return below
        v = tables[n].get(g, 0)
        own = max(v - discounts[n][min(v, 3) - 1], 0) / total if v else 0.0
        return own + spared[n][g[:-1]] / total * below

    known: dict[bytes, float] = {}

    def logp(text: bytes) -> float:
        padded = bytes(order - 1) + text.replace(b"\0", b"\1") + b"\0"
        out = 0.0
        for i in range(len(text) + 1):
            g = padded[i : i + order]
            if g not in known:
                known[g] = math.log(p(g))
            out += known[g]
        return out

    return logp


def rank(values: list[float], share: float) -> float:
    values = sorted(values)
    return values[max(0, math.ceil(share * len(values)) - 1)]


def fingerprint(text: str | None) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked_groups(prints: list[int], bits: int) -> list[int]:
    """Group number of each fingerprint, from all pairs."""
    distinct = sorted(set(prints))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= bits:
                root[find(a)] = find(b)
    return [find(f) for f in prints]


def repeated_bytes(docs: list[tuple[int, bytes]], least: int) -> list[bytearray]:
    """For documents in order of id, which bytes are covered by a window seen earlier."""
    seen, out = set(), []
    for _, text in docs:
        covered = bytearray(len(text))
        for i in range(len(text) - least + 1):
            window = text[i : i + least]
            if window in seen:
                covered[i : i + least] = b"\1" * least
            seen.add(window)
        out.append(covered)
    return out


def license_places(text: str | None, templates):
    """Words, (label, start) of every phrase, labels of all templates, best containment."""
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels, best = [], set(), 0.0
    for t in templates:
        size = len(set(t.words))
        for i in range(len(words)):
            block = words[i : i + len(t.words)]
            share = len(set(block) & set(t.words)) / size
            if share >= t.containment - 1e-9 and (not t.phrase or block == t.words):
                best = max(best, share)
                labels.add(t.label)
                if t.phrase:
                    places.append((t.label, i))
    return len(words), places, labels, best


def groups_of(values):
    out = defaultdict(list)
    for i, value in enumerate(values):
        out[value].append(i)
    return out
