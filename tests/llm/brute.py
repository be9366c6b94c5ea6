"""Plain versions of the operators, for small inputs."""

import re
from itertools import combinations

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def components(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {i: root(i) for i in ids}


def shingle_set(text, width):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)])


def similar(rows, width=3, percent=90):
    """doc_id: (n, component)."""
    sets = {r[0]: shingle_set(r[1], width) for r in rows if r[0] is not None}
    links = [
        (a, b) for a, b in combinations(sorted(sets), 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), c) for i, c in components(sets, links).items()}


def quality_counts(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    places = {}
    for i in range(len(w) - 7):
        places.setdefault(tuple(w[i : i + 8]), []).append(i)
    repeated = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated),
        len(w) < 20 or 100 * len(repeated) > 30 * len(w),
    )


def dedup_lines(rows, percent=80):
    """doc_id: (n_lines, n_removed, text)."""
    seen, out = [], {}
    for doc, text, *_ in sorted({r[:2] for r in rows}, key=lambda r: (r[0] is None, r[0] or 0)):
        left, n, gone = [], 0, 0
        for line in (text or "").split("\n"):
            s = frozenset(WORD.findall(line))
            n += bool(s)
            if s and any(100 * len(s & o) >= percent * len(s | o) for o in seen):
                gone += 1
            else:
                left.append(line)
            if s:
                seen.append(s)
        out[doc] = (n, gone, None if text is None else "\n".join(left))
    return out


def repeats(rows, length=100):
    """doc_id: (bytes, removed, spans, kept)."""
    seen, out = set(), {}
    for doc, text, *_ in sorted({r[:2] for r in rows if r[0] is not None}, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            if s in seen:
                gone[i : i + length] = [True] * length
            seen.add(s)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(raw), sum(gone), spans, bytes(b for b, g in zip(raw, gone) if not g))
    return out
