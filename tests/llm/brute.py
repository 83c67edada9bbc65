"""Plain versions that the operators are held against."""

import collections
import hashlib
import re

SPACE = re.compile("[\x20\x09-\x0d]+")
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def exact(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[SPACE.sub(" ", t or "")].append(i)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return out


def near(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            where[x].append(k)
    for k, s in enumerate(sets):
        shared = collections.Counter(j for x in s for j in where[x] if j < k)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(s) + len(sets[j]) - n):
                parent[find(k)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)]


def near_links(rows):
    """Per row the number of other sets that its set links with."""
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset())
    others = {s: sum(100 * len(s & o) >= 75 * len(s | o) for o in set(sets) if o and o != s) for s in set(sets)}
    return [(i, others[s] if s else 0) for (i, _), s in zip(rows, sets, strict=True)]


PII = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits):
    return sum(v - 9 * (v > 9) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits)))) % 10 == 0


def pii(text):
    out = []
    for kind, pattern in PII:
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            bad = kind == "ip" and any(int(x) > 255 for x in m[0].split("."))
            bad |= kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits))
            bad |= kind == "phone" and not 9 <= len(digits) <= 15
            if not bad:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out
