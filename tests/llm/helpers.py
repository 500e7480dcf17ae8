"""Brute-force models that several tests share."""

import re

_LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def word_set(text, k):
    words = re.findall(r"[^\x20\x09-\x0d]+", text.translate(_LOWER))
    if len(words) >= k:
        return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    return frozenset([tuple(words)] if words else [])


def line_of(text):
    return re.sub(r"[\x20\x09-\x0d]+", " ", text.translate(_LOWER)).strip(" ")


def linked(sets, num=80, den=100):
    """Smallest key reachable by links, by brute force over shared elements."""
    where, root = {}, {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, s in sets.items():
        count = {}
        for x in s:
            for j in where.setdefault(x, []):
                count[j] = count.get(j, 0) + 1
            where[x].append(i)
        for j, n in count.items():
            if den * n >= num * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}
