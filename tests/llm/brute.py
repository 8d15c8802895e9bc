"""Plain single-process versions of the contracts, to compare with."""

import hashlib
import re
import zlib
from collections import Counter

SPACED = re.compile("[^\x20\x09-\x0d]+")
FOLDED = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(0x41, 0x5B)})


def words(text):
    return SPACED.findall(text or "")


def op3(rows, size=50):
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if doc is not None and first[tuple(w[i : i + size])] < doc:
                gone[i : i + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, n=5):
    w = words((text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def op4(rows):
    sets = [(doc, shingles(text)) for doc, text in rows]
    parent = {doc: doc for doc, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for k, (_, s) in enumerate(sets):
        for t in s:
            holders.setdefault(t, []).append(k)
    seen = set()
    for ks in holders.values():
        for i, a in enumerate(ks):
            for b in ks[i + 1 :]:
                if (a, b) in seen:
                    continue
                seen.add((a, b))
                x, y = sets[a], sets[b]
                common = len(x[1] & y[1])
                if 100 * common >= 75 * (len(x[1]) + len(y[1]) - common) and None not in (x[0], y[0]):
                    low, high = sorted((find(x[0]), find(y[0])))
                    parent[high] = low
    return [(doc, len(s), find(doc)) for doc, s in sets]


def op6(rows, items, size=10):
    patterns = {}
    for item, text in items:
        w = FOLDED.findall((text or "").translate(UPPER))
        for i in range(max(min(len(w), 1), len(w) - size + 1)):
            patterns.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    lengths = {len(p) for p in patterns}
    out = []
    for doc, text in rows:
        w = FOLDED.findall((text or "").translate(UPPER))
        hit, ids = [False] * len(w), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                found = patterns.get(tuple(w[i : i + n]))
                if found:
                    hit[i : i + n] = [True] * n
                    ids |= found
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc, len(w), sum(hit), len(ids), digest, sum(hit) > 0))
    return out


def op2(text):
    w = words(text)
    text = text or ""
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    tri = list(zip(w, w[1:], w[2:], strict=False))
    many = Counter(tri)
    covered = set()
    for i, t in enumerate(tri):
        if many[t] > 1:
            covered.update((i, i + 1, i + 2))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def crc(ids):
    return zlib.crc32(b"".join(int(i).to_bytes(4, "little") for i in ids))
