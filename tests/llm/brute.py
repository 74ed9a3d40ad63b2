"""Plain Python versions of the corpus operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LOWER = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": dup,
        "n_repeat_words": len(hit), "base_failed": len(words) < 50 or 100 * len(hit) > 50 * len(words),
    }


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def near_duplicates(rows):
    """rows: (doc_id, text); {doc_id: (n_shingles, component_id)}."""
    sets = {k: shingles(t) for k, t in rows}
    root = {k: k for k in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((top(a), top(b)))
                    root[y] = x
    return {k: (len(s), top(k)) for k, s in sets.items()}


def decontamination(docs, items):
    """docs, items: (id, text); {doc_id: (n_words, n_hit, n_items, items_sha256)}."""
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        k = min(10, len(words))
        for i in range(len(words) - k + 1 if k else 0):
            windows[tuple(words[i : i + k])].add(str(item))
    out = {}
    for doc, text in docs:
        words, hit, found = ALNUM.findall((text or "").translate(LOWER)), set(), set()
        for k in {len(w) for w in windows}:
            for i in range(len(words) - k + 1):
                if tuple(words[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    found |= windows[tuple(words[i : i + k])]
        out[doc] = (len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())
    return out


ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    text = text or ""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    order = ("assign", "access", "hex")
    return sorted(found, key=lambda s: (s[1], order.index(s[0])))
