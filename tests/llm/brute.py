"""Plain Python versions of the operators' definitions."""

import collections
import hashlib
import re

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, k):
    w = words(lower(text))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def jaccard_components(docs, k, num, den):
    """{doc_id: (n, component)} of (doc_id, text) rows."""
    sets = {i: shingles(t, k) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and find(a) != find(b):
                both = len(sets[a] & sets[b])
                if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def repeats(rows, length):
    """[(n_bytes, removed flags)] of texts: bytes that a string of ``length`` found twice covers."""
    raw = [(t or "").encode() for t in rows]
    seen = collections.Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        out.append((b, gone))
    return out


def first_kept(rows, length):
    """As ``repeats``, but only strings that began earlier, in row and place order, are removed."""
    raw = [(t or "").encode() for t in rows]
    seen, out = set(), []
    for b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if b[i:i + length] in seen:
                gone[i:i + length] = [True] * length
            seen.add(b[i:i + length])
        out.append((b, gone))
    return out


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    count = collections.Counter(windows)
    inside = {j for i, x in enumerate(windows) if count[x] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def _any_case(word):
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile("(?:" + "|".join(_any_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + _any_case("api") + "_?"
                    + _any_case("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(1)) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(v if i % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v) for i, v in enumerate(map(int, reversed(digits)))) % 10 == 0


def pii(text):
    def passes(kind, m):
        d = re.sub("[^0-9]", "", m)
        return (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.split("."))
                or kind == "card" and 16 <= len(d) <= 19 and luhn(d) or kind == "phone" and 8 <= len(d) <= 15)
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PII.items() for m in re.finditer(p, text or "") if passes(k, m.group()))


BASE_LICENCES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]


def licences(text):
    """n_words, places [(start, label)]."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return len(w), sorted((i, label) for p, label in BASE_LICENCES for i in range(len(w)) if w[i:i + len(p.split())] == p.split())


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else bytes(text)).hexdigest()
