"""Edit distances that know how people mistype."""

from __future__ import annotations

#: Neighbours on a QWERTY keyboard (fixed values).
NEIGHBOURS = {
    "q": "wa", "w": "qesa", "e": "wrds", "r": "etfd", "t": "rygf", "y": "tuhg", "u": "yijh", "i": "uokj",
    "o": "iplk", "p": "ol", "a": "qwsz", "s": "awedxz", "d": "serfcx", "f": "drtgvc", "g": "ftyhbv",
    "h": "gyujnb", "j": "huikmn", "k": "jiolm", "l": "kop", "z": "asx", "x": "zsdc", "c": "xdfv",
    "v": "cfgb", "b": "vghn", "n": "bhjm", "m": "njk",
}

SLIP = 1.0
#: A substitution of keys that aren't neighbours is rarely a slip.
OTHER = 2.0


def typing_distance(a: str, b: str, limit: float = 3.0) -> float:
    """Weighted Damerau-Levenshtein distance, or more than ``limit``.

    Insertions, deletions, transpositions of neighbours in the text and
    substitutions of neighbouring keys cost SLIP, other substitutions OTHER.
    """
    if a == b:
        return 0.0
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    start = 0
    while start < len(a) and start < len(b) and a[start] == b[start]:
        start += 1
    while len(a) > start and len(b) > start and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    a, b = a[start:], b[start:]
    two: list[float] = []
    one = [SLIP * j for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        row = [SLIP * i]
        for j, y in enumerate(b, 1):
            cost = 0.0 if x == y else SLIP if y in NEIGHBOURS.get(x, "") else OTHER
            best = min(one[j] + SLIP, row[j - 1] + SLIP, one[j - 1] + cost)
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, two[j - 2] + SLIP)
            row.append(best)
        if min(row) > limit:
            return limit + 1
        two, one = one, row
    return one[-1]
