"""Plain versions of the operators, for small tables."""

import re
from collections import Counter, defaultdict

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w for w in BLANK.split(text or "") if w]


def components(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def near(docs, width, percent):
    """{doc_id: (set size, component)} of [(doc_id, text)]."""
    sets = {}
    for i, text in docs:
        w = words(lower(text or ""))
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    common = Counter((a, b) for h in holders.values() for k, a in enumerate(h) for b in h[:k])
    links = [p for p, n in common.items() if 100 * n >= percent * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    found = components(sets, links)
    return {i: (len(sets[i]), found[i]) for i in sets}


def passages(docs, width):
    """{doc_id: (words, removed, kept words)}"""
    first = {}
    lists = {i: words(t) for i, t in docs}
    for i, w in lists.items():
        for k in range(len(w) - width + 1):
            g = tuple(w[k:k + width])
            first[g] = min(first.get(g, i), i)
    out = {}
    for i, w in lists.items():
        gone = {k + j for k in range(len(w) - width + 1) if first[tuple(w[k:k + width])] < i for j in range(width)}
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def lines(docs, least):
    """{doc_id: (lines, dropped, kept text)}"""
    key = lambda s: lower(s.strip(" \t\n\x0b\x0c\r"))
    first = {}
    for i, t in docs:
        for s in (t or "").split("\n"):
            first[key(s)] = min(first.get(key(s), i), i)
    out = {}
    for i, t in docs:
        every = (t or "").split("\n")
        kept = [s for s in every if not (len(key(s)) >= least and first[key(s)] < i)]
        out[i] = (len(every), len(every) - len(kept), "\n".join(kept))
    return out


def leaks(docs, items, width):
    """{doc_id: (words, hit words, sorted item ids)}"""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = defaultdict(set)
    for item, t in items:
        w = split(t)
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k:k + n])].add(str(item))
    out = {}
    for i, t in docs:
        w, hit, found = split(t), set(), set()
        for n in {len(g) for g in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k:k + n])):
                    hit |= set(range(k, k + n))
                    found |= own
        out[i] = (len(w), len(hit), sorted(found))
    return out


RULES = (("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
         ("access", r"AKIA[A-Z0-9]+", 0, 20), ("hex", r"[0-9a-f]+", 0, 24))


def secrets(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, pattern, group, least) in enumerate(RULES)
             for m in re.finditer(pattern, text or "", re.ASCII) if len(m[group]) >= least]
    return ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in sorted(found))
