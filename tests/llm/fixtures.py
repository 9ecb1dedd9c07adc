"""Small tables with awkward rows, and brute force."""

import re
from collections import defaultdict

TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NOUNS = "river stone letter garden engine copper window shadow market winter island bridge paper silver forest thunder candle harbor".split()


def sentence(seed: int, n: int) -> str:
    x = seed * 7919 + 13
    out = []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(NOUNS[x // 7 % len(NOUNS)] + str(x // 1000 % 97))
    return " ".join(out)


def components(n, links):
    up = list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def shingles(text, k=5):
    w = WORD.findall((text or "").translate(TO_LOWER))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near_pairs(texts, num=80, den=100):
    sets = [shingles(t) for t in texts]
    inverted = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            inverted[x].append(i)
    tried = {(i, j) for v in inverted.values() for i in v for j in v if i < j}
    return sets, {(i, j) for i, j in tried if den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])}


def edited(text, *places):
    w = text.split(" ")
    for p in places:
        w[p % len(w)] = f"edit{p}"
    return " ".join(w)
