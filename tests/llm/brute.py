"""Plain forms of the operators on documents, over all pairs."""

import re

SPLIT = re.compile(r"[^\W_]+")


def words(text):
    return SPLIT.findall((text or "").lower())


def units(text):
    """Words, where each letter of a script without blanks is one (those of the tests)."""
    return [u for w in words(text) for u in re.findall(r"[\u3040-\u30ff\u4e00-\u9fff]|[^\u3040-\u30ff\u4e00-\u9fff]+", w)]


def runs(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def near(rows):
    """rows: (doc_id, text). (class_id, links) of each row, in order."""
    sets = [runs(t) for _, t in rows]
    linked = [
        [j for j, b in enumerate(sets) if j != i and a and b and 10 * len(a & b) >= 8 * len(a | b) - 1e-6]
        for i, a in enumerate(sets)
    ]
    comp = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, own in enumerate(linked):
            least = min([comp[i], *(comp[j] for j in own)])
            changed |= least != comp[i]
            comp[i] = least
    ids = {}
    for i, c in enumerate(comp):
        if rows[i][0] is not None:
            ids[c] = min(ids.get(c, rows[i][0]), rows[i][0])
    return [(ids.get(c), len(own)) for c, own in zip(comp, linked, strict=True)]


def contaminated(text, items, window=13, share=0.8, least=8):
    """Numbers of the items that agree with the text in a window, in place, by words or by units."""
    forms = [words(text), units(text)]
    return [k for k, item in enumerate(items) if any(_agree(w, v, window, share, least) for w in forms for v in (words(item), units(item)))]


def _agree(w, v, window, share, least):
    if len(v) < least:
        return False
    n = min(window, len(v))
    need = -(-int(share * n * 1000) // 1000)
    for shift in range(-len(v), len(w)):
        same = [0 <= i + shift < len(w) and w[i + shift] == x for i, x in enumerate(v)]
        inside = [0 <= i + shift < len(w) for i in range(len(v))]
        if any(sum(same[i : i + n]) >= need and all(inside[i : i + n]) for i in range(len(v) - n + 1)):
            return True
    return False
