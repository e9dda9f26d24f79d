"""Plain versions of the operators' definitions."""

import re

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def jaccard_components(rows, n, per_cent):
    """``(doc_id, size, component)`` of ``(doc_id, text)`` rows."""
    sets = [shingle_set(t, n) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        common = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if 100 * c >= per_cent * (len(s) + len(sets[j]) - c):
                parent[root(i)] = root(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[root(i)] = min(low.get(root(i), doc), doc)
    return [(doc, len(sets[i]), low.get(root(i)) if sets[i] else doc) for i, (doc, _) in enumerate(rows)]
