"""Plain versions of the operators for small tables."""

import hashlib
import re

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def words(text, lower=False):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
    return SPLIT.findall(text)


def removed(docs, length=50):
    """{(doc_id, text): (n_words, n_removed, sha256 of what is kept)}."""
    least = {}
    for i, text in docs:
        w = words(text)
        for s in range(len(w) - length + 1):
            k = tuple(w[s : s + length])
            least[k] = min(i, least.get(k, i))
    out = {}
    for i, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            if least[tuple(w[s : s + length])] < i:
                gone[s : s + length] = [True] * length
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[i, text] = (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def shingles(text, n):
    w = words(text, lower=True)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1)))


def linked(docs, n, num, den):
    """[(doc_id, set size, component)] in the order of ``docs``."""
    sets = [shingles(t, n) for _, t in docs]
    holders = {}
    for k, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, s in enumerate(sets):
        common = {}
        for x in s:
            for other in holders[x]:
                if other < k:
                    common[other] = common.get(other, 0) + 1
        for other, c in common.items():
            if den * c >= num * (len(s) + len(sets[other]) - c):
                parent[find(other)] = find(k)
    least = {}
    for k, (i, _) in enumerate(docs):
        r = find(k)
        least[r] = min(i, least.get(r, i))
    return [(i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(docs)]
