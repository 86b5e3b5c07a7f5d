"""Plain Python forms of the operators, for small inputs."""

import hashlib
import re

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


def base_spans(text):
    """(kind, start, end) of the fixed patterns, by kind and place."""
    text = text or ""
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15]
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def without_repeats(docs, window=13):
    """doc_id -> (words, removed, digest of what stays) for (doc_id, text) pairs."""
    least = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            least[g] = min(i, least.get(g, i))
    out = []
    for i, t in docs:
        w, gone = words(t), set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def shingles(text, length=3):
    w = words(fold(text))
    if 0 < len(w) < length:
        return {tuple(w)}
    return {tuple(w[k : k + length]) for k in range(len(w) - length + 1)}


def components(docs, percent=90):
    """doc_id -> (set size, smallest linked id)."""
    sets = [(i, shingles(t)) for i, t in docs]
    label = {i: i for i, _ in sets}
    for a, s in sets:
        for b, t in sets:
            if a < b and s and t and 100 * len(s & t) >= percent * len(s | t):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    return sorted((i, len(s), label[i]) for i, s in sets)


def contamination(docs, items, window=13):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    tests = [(str(i), pattern.findall(fold(t))) for i, t in items]
    out = []
    for i, t in docs:
        w, hit, found = pattern.findall(fold(t)), set(), set()
        for name, own in tests:
            size = min(len(own), window)
            for first in range(len(own) - size + 1) if size else ():
                for k in range(len(w) - size + 1):
                    if w[k : k + size] == own[first : first + size]:
                        hit.update(range(k, k + size))
                        found.add(name)
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w)))
    return out
