"""Brute-force versions the operators are compared with, and a table of awkward rows."""

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, doc string, rank int, group string, row long, key string, _id long"


def awkward_rows():
    """Nulls, empty and very long texts, repeats and ties; the last columns clash with inner names."""
    base = "the quick brown fox jumps over the lazy dog near the old river bank today"
    texts = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, "a b c", None, "b"), (3, "a b c", None, "b"), (4, "a b c", "en", None),
        (5, LONG, "en", "a"), (6, LONG, "en", "a"), (7, "y" * 120_000, "en", "b"), (8, "\U0001F642 —", "en", "b"),
        (9, base, "en", "a"), (10, base + " again", "en", "b"), (11, base.upper(), None, None), (12, " \t\n ", "de", None),
        (13, "été 中文 naïve", "fr", "c"), (14, base + " and more words of its own that change it all", "en", "c"),
        (None, "row without id", "en", "c"), (16, LONG[:64], "en", "c"), (17, LONG[:65], "en", "c"), (18, LONG[:640], "en", "c"),
    ]
    return [(i, t, lang, s, len(t or ""), "d", 1, "g", 2, "k", 3) for i, t, lang, s in texts]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingle_set(text):
    w = words(text)
    if len(w) >= 5:
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    return frozenset([tuple(w)]) if w else frozenset()


def near_components(rows):
    """rows of (doc_id, text); component by linking all pairs."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            union = len(sets[a] | sets[b])
            if union and 100 * common >= 75 * union:
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def mix_targets(sizes, weights=(5, 2, 1), most=3):
    """sizes by source; share by weight, cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_sources = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while open_sources and left > 1e-9:
        total = sum(weight[s] for s in open_sources)
        full = {s for s in open_sources if target[s] + left * weight[s] / total >= most * sizes[s]}
        share = left / total
        if not full:
            for s in open_sources:
                target[s] += share * weight[s]
            left = 0
        else:
            # Fill those that reach their cap and share what is then left among all others anew.
            for s in full:
                left += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
            open_sources -= full
    return target


def count(rows):
    return Counter(map(repr, rows))
