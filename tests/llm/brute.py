"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

NO_ID = -(2**63)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def key(doc_id):
    return NO_ID if doc_id is None else doc_id


def words(text):
    return WORD.findall(text or "")


class Groups:
    def __init__(self):
        self.parent = {}

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def substring_dedup(docs, width):
    """(doc_id, n_words, n_removed, kept) of (doc_id, text) rows."""
    split = [(i, words(t)) for i, t in docs]
    first = {}
    for i, w in split:
        for k in range(len(w) - width + 1):
            window = tuple(w[k : k + width])
            first[window] = min(first.get(window, key(i)), key(i))
    rows = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < key(i):
                gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        rows.append((i, len(w), len(gone), kept))
    return rows


def suffix_dedup(docs, length):
    """(doc_id, n_bytes, n_removed, n_spans, kept bytes)."""
    raw = [(i, (t or "").encode()) for i, t in docs]
    counts = Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    rows = []
    for i, b in raw:
        gone = bytearray(len(b) + 1)
        for k in range(len(b) - length + 1):
            if counts[b[k : k + length]] > 1:
                gone[k : k + length] = b"\x01" * length
        spans = sum(gone[k] and not (k and gone[k - 1]) for k in range(len(b)))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        rows.append((i, len(b), sum(gone), spans, kept))
    return rows


def shingles(text, n):
    w = words((text or "").translate(LOWER))
    if len(w) < n:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}


def jaccard_join(docs, n, percent):
    """(doc_id, n_shingles, component_id)."""
    sets = [(i, shingles(t, n)) for i, t in docs]
    places = defaultdict(list)
    for number, (i, s) in enumerate(sets):
        if i is not None:
            for x in s:
                places[x].append(number)
    common = Counter(
        (a, b) for at in places.values() for j, b in enumerate(at) for a in at[:j]
    )
    groups = Groups()
    for (a, b), both in common.items():
        union = len(sets[a][1]) + len(sets[b][1]) - both
        if 100 * both >= percent * union:
            groups.join(sets[a][0], sets[b][0])
    return [(i, len(s), None if i is None else groups.root(i)) for i, s in sets]


ASSIGN = re.compile(
    r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)


def base_spans(text):
    """(start, kind, stop) of the base kinds."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def redacted(text, mark="[secret]"):
    done, at = "", 0
    for start, _, stop in base_spans(text):
        if not (start <= at and at > 0):
            done += text[at:start] + mark
        at = max(at, stop)
    return done + text[at:]


LICENSE_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}


def license_places(text):
    """Number of words, and (start, label) of each base phrase."""
    w = LICENSE_WORD.findall((text or "").translate(LOWER))
    found = [
        (k, label)
        for label, phrase in PHRASES.items()
        for k in range(len(w))
        if w[k : k + len(phrase.split())] == phrase.split()
    ]
    return len(w), sorted(found)
