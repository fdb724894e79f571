"""Plain Python versions of the operators, straight from their definitions."""

import hashlib
import re

BLANK = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text, rule=BLANK):
    return re.findall(rule, text or "")


def secrets(text):
    text = text or ""
    assign = (
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    found = [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text, re.A) if len(m[1]) >= 8]
    for rank, (kind, rule, least) in enumerate([("access", r"AKIA[A-Z0-9]+", 16), ("hex", r"[0-9a-f]+", 32)], 1):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(rule, text) if len(m[0]) >= least]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


def repeats(rows, k):
    """{doc_id: set of removed word places} for windows that also start in a smaller document."""
    first = {}
    split = {i: words(t) for i, t in rows}
    for i, w in split.items():
        for p in range(len(w) - k + 1):
            key = tuple(w[p : p + k])
            first[key] = min(first.get(key, i), i)
    return {
        i: {q for p in range(len(w) - k + 1) if first[tuple(w[p : p + k])] < i for q in range(p, p + k)}
        for i, w in split.items()
    }


def removed(rows, k):
    gone = repeats(rows, k)
    return {
        (i, len(words(t)), len(gone[i]), " ".join(x for p, x in enumerate(words(t)) if p not in gone[i]))
        for i, t in rows
    }


def shingles(text):
    w = words(lower(text))
    if not w:
        return set()
    return {tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4))}


def groups(rows):
    """{doc_id: smallest linked doc_id}."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def contamination(rows, items, k=10):
    windows = {}
    for item, text in items:
        w = words(lower(text), ALNUM)
        for p in range(max(1, len(w) - k + 1)) if w else ():
            windows.setdefault(tuple(w[p : p + k]), set()).add(str(item))
    out = set()
    for i, text in rows:
        w, hit, named = words(lower(text), ALNUM), set(), set()
        for size in {len(x) for x in windows}:
            for p in range(len(w) - size + 1):
                if tuple(w[p : p + size]) in windows:
                    hit |= set(range(p, p + size))
                    named |= windows[tuple(w[p : p + size])]
        out.add((i, len(w), len(hit), len(named), sha(",".join(sorted(named))), bool(hit)))
    return out


def quality(text):
    text = text or ""
    w = words(text)
    grams = [tuple(w[p : p + 3]) for p in range(len(w) - 2)]
    inside = {q for p, g in enumerate(grams) if grams.count(g) > 1 for q in range(p, p + 3)}
    lines = [x for x in text.split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len(inside), failed)
