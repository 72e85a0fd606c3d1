"""Small hostile tables, and plain versions of the operators."""

import random
import re

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, doc string, print int, key int, w int, place int, leader int, n int, window string"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randint(0, 99)) for _ in range(n))


def hostile(spark, extra=()):
    """Nulls in every column, empty, blank and very long texts, repeats, ties, and names that clash with ours."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    texts = [(1, base), (2, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, "  \n\t "), (7, "one"),
             (8, "ONE"), (None, base), (None, None), (9, prose(2, 30_000)), (10, "x" * 200_000), (11, prose(3, 40)),
             (11, prose(4, 40)), (12, "café 日本語 \U0001f600 " + prose(5, 60)), (13, "İstanbul AΣ ΑΣ'Β á"),
             *extra]
    rows = [(i, t, None if k % 2 else "x", k, None, k, 0, 1, None, None) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def groups(docs, n, percent):
    """Smallest key reachable by links, by trying all pairs."""
    sets = [(i, shingles(t, n)) for i, t in docs if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in root}


def item_words(text):
    return re.findall(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").encode().translate(
        bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))))


def hits(text, items, size=10):
    """Hit words, and the items with an occurring window."""
    w, covered, found = item_words(text), set(), set()
    for item, t in items:
        v = item_words(t)
        k = min(size, len(v))
        for s in {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if v and item is not None else ():
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) == s:
                    covered.update(range(i, i + k))
                    found.add(str(item))
    return len(w), len(covered), sorted(found)


def without(docs, n=50):
    """Bytes left of each text, and the number of removed runs."""
    least, out = {}, []
    for i, t in docs:
        b = (t or "").encode()
        for p in range(len(b) - n + 1) if i is not None else ():
            s = b[p:p + n]
            least[s] = min(least.get(s, i), i)
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1) if i is not None else ():
            if least[b[p:p + n]] < i:
                gone[p:p + n] = b"\1" * n
        out.append((i, bytes(c for c, g in zip(b, gone) if not g), len(re.findall(b"\1+", bytes(gone)))))
    return out
