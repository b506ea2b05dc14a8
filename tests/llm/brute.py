"""Plain versions of the operators for small inputs."""

import base64
import hashlib
import re
from collections import defaultdict


def words(text):
    return (text or "").encode().split()


def base_counts(text):
    w, text = words(text), text or ""
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i:i + 5])].append(i)
    hit = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(hit))


def base_failed(text):
    n, *_, repeated = base_counts(text)
    return n < 10 or 100 * repeated > 20 * n


def grams(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(docs):
    """doc_id to (set size, smallest linked id); ids are distinct and not null."""
    sets = {i: grams(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                common = len(sets[x] & sets[y])
                if 100 * common >= 80 * (len(sets[x]) + len(sets[y]) - common):
                    a, b = sorted((find(x), find(y)))
                    root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def without_repeats(docs, window):
    """doc_id, units and mask of removed units; units are sequences (words or bytes)."""
    first = {}
    for i, units in docs:
        for k in range(len(units) - window + 1):
            key = tuple(units[k:k + window])
            first[key] = min(first.get(key, i), i)
    for i, units in docs:
        gone = set()
        for k in range(len(units) - window + 1):
            if first[tuple(units[k:k + window])] < i:
                gone.update(range(k, k + window))
        yield i, units, gone


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def personal(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def spans(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items()
            for m in re.finditer(p, text or "") if personal(k, m.group())]


def masked(text):
    for kind, pattern in PATTERNS.items():
        text = re.sub(pattern, lambda m, k=kind: f"[{k.upper()}]" if personal(k, m.group()) else m.group(), text)
    return text


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()
