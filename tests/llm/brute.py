"""Plain single-process versions of the contracts, for comparison."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash

BLANK = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[BLANK.sub("", t or "")].append((-len(t or ""), i is None, i if i is not None else 0))
    out = []
    for i, t in rows:
        g = groups[BLANK.sub("", t or "")]
        least = min(g)
        keep = None if least[1] else least[2]
        out.append((i, keep, len(g), i == keep, sha(BLANK.sub("", t or ""))))
    return out


def fingerprint(text, shingle=3):
    w = WORD.findall((text or "").translate(LOWER))
    s = [" ".join(w[k:k + shingle]) for k in range(len(w) - shingle + 1)] if len(w) > shingle else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def components(fps, bits=3):
    """{fp: least fp reachable} by comparing all with all."""
    f = np.array(sorted(set(fps)), dtype=np.uint64)
    parent = list(range(len(f)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(f)):
        for b in (np.flatnonzero(np.bitwise_count(f[a + 1:] ^ f[a]) <= bits) + a + 1).tolist():
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    return {int(f[i]): int(f[find(i)]) for i in range(len(f))}


def simhash(rows):
    fp = [(i, fingerprint(t)) for i, t in rows]
    comp = components([f for _, f in fp])
    least = {}
    for i, f in fp:
        if i is not None:
            least[comp[f]] = min(least.get(comp[f], i), i)
    return [(i, f"{f:016x}", least.get(comp[f])) for i, f in fp]


def line_dedup(rows, min_docs=10):
    def key(x):
        return x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    n = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if n[key(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(stay), sha("\n".join(stay))))
    return out


def targets(sizes, weights=(1, 2, 3), most=3):
    """{source: target} by sharing again and again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in stopped)
        open_w = sum(w[s] for s in names if s not in stopped)
        t = {s: most * sizes[s] if s in stopped else left * w[s] / open_w for s in names}
        above = {s for s in names if s not in stopped and t[s] > most * sizes[s]}
        if not above:
            return t
        stopped |= above


def luhn(d):
    s = [int(c) for c in reversed(d)]
    return (sum(s[::2]) + sum(sum(divmod(2 * x, 10)) for x in s[1::2])) % 10 == 0


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def spans_text(spans):
    return ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in spans)


def part(doc_id, mod):
    return zlib.crc32(str(doc_id).encode()) % mod
