"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict

_LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    if len(w) >= words:
        return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def groups(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def jaccard_components(rows, words, percent):
    """[(doc_id, set size, smallest id reachable)] of rows (doc_id, text)."""
    sets = [shingles(t, words) for _, t in rows]
    held, links = defaultdict(list), []
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for t in s:
            for j in held[t]:
                common[j] += 1
            held[t].append(i)
        links += [(i, j) for j, c in common.items() if 100 * c >= percent * (len(s) + len(sets[j]) - c)]
    roots = groups(len(rows), links)
    least = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    return [(i, len(s), least.get(r) if s else i) for (i, _), s, r in zip(rows, sets, roots)]


def whole_lines(rows, order):
    """Texts of rows (doc_id, text) without the lines that repeat or nearly repeat an earlier one; order: key of a row.

    Every line that is not blank takes part, by the 16 characters from every offset.
    """
    places = []
    for doc in sorted(range(len(rows)), key=order):
        for at, line in enumerate((rows[doc][1] or "").split("\n")):
            if line.strip(" \t\r"):
                places.append((doc, at, line.strip(" \t\r")))
    distinct = list(dict.fromkeys(p for *_, p in places))
    sets = [{x[i : i + 16] for i in range(max(1, len(x) - 15))} for x in distinct]
    links = []
    held = defaultdict(list)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for t in s:
            for j in held[t]:
                common[j] += 1
            held[t].append(i)
        links += [(i, j) for j, c in common.items() if 100 * c >= 80 * (len(s) + len(sets[j]) - c)]
    root = dict(zip(distinct, groups(len(distinct), links)))
    seen, gone = set(), defaultdict(set)
    for doc, at, plain in places:
        if root[plain] in seen:
            gone[doc].add(at)
        seen.add(root[plain])
    return [
        t if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[d]) for d, (_, t) in enumerate(rows)
    ]


def paragraphs(text):
    return {x.strip(" \t\r\n") for x in re.findall(r"(?:\S+[^\S\n]*){1,24}\n?", text or "", re.A)}
