"""Plain row-at-a-time versions of the contracts of op1 to op10, written apart from the operators."""

from __future__ import annotations

import re
from collections import Counter
from hashlib import sha256
from itertools import pairwise
from zlib import crc32

ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
KINDS = ["assign", "access", "hex"]


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    found.sort()
    n = Counter(k for _, k, _ in found)
    return n[0], n[1], n[2], sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in found).encode()).hexdigest()


UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def quality(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)}
    repeat = len(covered)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat, len(w) < 50 or 100 * repeat > 50 * len(w)


def shingles(text, size=5):
    w = re.sub(r"[\x20\x09-\x0D]+", " ", (text or "").translate(UPPER)).split(" ")
    w = [x for x in w if x]
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def near_classes(rows, least=0.8):
    """{doc_id: least doc_id of its connected component}; rows: [(doc_id, text)]."""
    sets = {d: shingles(t) for d, t in rows}
    at: dict = {}
    for d, s in sets.items():
        for x in s:
            at.setdefault(x, []).append(d)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    both = Counter()
    for ds in at.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1 :]:
                both[a, b] += 1
    for (a, b), n in both.items():
        if n / (len(sets[a]) + len(sets[b]) - n) >= least:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {d: root(d) for d in sets}


def held_out(doc_id, mod):
    return crc32(str(doc_id).encode()) % mod == 2


def levenshtein_at_most(a: str, b: str, k: int) -> bool:
    if abs(len(a) - len(b)) > k:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        after = [i]
        for j, (y, (up, left)) in enumerate(zip(b, pairwise(row), strict=True), 1):
            after.append(min(up + (x != y), left + 1, after[-1] + 1))
        row = after
        if min(row) > k:
            return False
    return row[-1] <= k


def kept(texts, labels, failed):
    """{doc_id: verdict} of the likelihood ratio over hashed byte trigrams, counted one by one. All labelled documents are in the sample."""
    from collections import Counter
    from math import log

    def grams(t):
        b = (t or "").encode()
        return [(((b[i] << 16 | b[i + 1] << 8 | b[i + 2]) * 2654435761) & 0xFFFFFFFF) >> 16 for i in range(len(b) - 2)]

    own = {d: grams(t) for d, t in texts.items()}
    target = Counter(g for d, x in own.items() if labels.get(d) == 1 and texts[d] is not None for g in x)
    raw = Counter(g for x in own.values() for g in x)
    nt, nr, cells = sum(target.values()), sum(raw.values()), 1 << 16
    if not nt:
        return {d: not failed[d] for d in texts}
    ratio = {g: log((target[g] + 0.5) / (nt + 0.5 * cells)) - log((n + 0.5) / (nr + 0.5 * cells)) for g, n in raw.items()}
    score = {d: sum(ratio[g] for g in x) / len(x) if x else 0.0 for d, x in own.items()}
    good, bad = (sorted(score[d] for d in texts if labels.get(d) == q and texts[d] is not None and not failed[d]) for q in (1, 0))
    top = good[int(0.001 * len(good))] if good else float("-inf")
    below = [x for x in bad if x < top]
    cut = float("-inf") if not good else (below[-1] + top) / 2 if below else top - abs(top) - 0.05
    return {d: not failed[d] and score[d] >= cut for d in texts}


def license_labels(text):
    """(labels, score) by every rule on every text that holds its keyword, and pairwise suppression."""
    from lodestrand.llm import licenses

    line = f" {' '.join(x.translate(UPPER) for x in re.findall(r'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+', (text or '').translate(UPPER)))} "
    hits = [] if not re.search(licenses._GATE, text or "") else [
        (m.start(), m.start() + len(m[0]), priority, order, label)
        for order, (label, priority, keyword, pattern) in enumerate(licenses.RULES) if f" {keyword} " in line
        for m in re.finditer(f" (?:{pattern})(?= )", line)
    ]
    left = [h for h in hits if not any(g is not h and g[0] <= h[0] and h[1] <= g[1] and g[2] >= h[2] and (g[:3] != h[:3] or g[3] < h[3]) for g in hits)]
    base = {label for phrase, label in licenses.PHRASES.items() if f" {phrase} " in line}
    top = max([h[2] for h in left] + [3] * bool(base), default=0)
    return ",".join(sorted(base | {h[4] for h in left})), round(top / max(p for _, p, _, _ in licenses.RULES), 9)


def boxes(data):
    """{kind: bodies} of all boxes of an ISO media file, nested ones too."""
    out = {}

    def walk(part):
        while len(part) >= 8:
            size, kind, head = int.from_bytes(part[:4]), part[4:8].decode("latin-1"), 8
            if size == 1:
                size, head = int.from_bytes(part[8:16]), 16
            size = size or len(part)
            out.setdefault(kind, []).append(part[head:size])
            if kind in ("moov", "trak", "mdia", "minf", "stbl"):
                walk(part[head:size])
            part = part[size:]

    walk(data)
    return out
