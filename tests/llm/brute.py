"""Plain models the operators are compared with."""

from __future__ import annotations


def shingle_set(text: str | None, words: int = 5) -> frozenset:
    # only A-Z count as a-z, only these six characters part words
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\v\f\r":
        lowered = lowered.replace(space, " ")
    found = [w for w in lowered.split(" ") if w]
    if not found:
        return frozenset()
    if len(found) < words:
        return frozenset([tuple(found)])
    return frozenset(tuple(found[k : k + words]) for k in range(len(found) - words + 1))


def jaccard_classes(rows, percent: int = 75, words: int = 5):
    """(id, set size, least id reachable) for each row (id, text)."""
    sets = [shingle_set(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least: dict[int, int] = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            r = root(k)
            least[r] = min(i, least.get(r, i))
    return [(i, len(sets[k]), least.get(root(k))) for k, (i, _) in enumerate(rows)]
