"""Plain versions of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter


def words(text):
    low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingle_set(text):
    w = words(text)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def near_copies(rows):
    """(n_shingles, component) for each (id, text), in order."""
    sets = [shingle_set(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                comp[root(i)] = root(j)
    ids = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[root(i)] = min(key, ids.get(root(i), key))
    return [(len(s), ids.get(root(i)) if s else rows[i][0]) for i, s in enumerate(sets)]


BASE = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    total = 0
    for i, x in enumerate(reversed(digits)):
        d = int(x) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for k, pattern in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            digits = [x for x in m.group() if x in "0123456789"]
            if k == 1 and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if k == 2 and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return sorted(out)


def spans_hash(spans):
    names = ("email", "ip", "card", "phone")
    return hashlib.sha256(",".join(f"{names[k]}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()


def closest(pattern, text):
    """Edit distance of pattern to its closest stretch of text."""
    last = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        row = [i]
        for j, y in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return min(last)


def maglev(names, size, number):
    """The table, slot by slot, by trying each shard's whole permutation."""
    orders = [[(number(f"offset:{x}") % size + i * (number(f"skip:{x}") % (size - 1) + 1)) % size for i in range(size)] for x in names]
    table, turn = {}, 0
    while len(table) < size:
        k = turn % len(names)
        slot = next(x for x in orders[k] if x not in table)
        table[slot] = k
        turn += 1
    return [table[i] for i in range(size)]


def periodic_runs(words):
    """(start, length, period) of each run, by trying all periods."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(words) if i not in gone)


def planted(key, words):
    h, n = zlib.crc32(str(key).encode()), len(words)
    if key is None or h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, most=20):
    """(item, rank, id, score), by scoring all documents for all items."""
    terms = lambda t: TERM.findall("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in t or ""))
    counts = [(key, Counter(terms(t))) for key, t in docs]
    counts = [(key, c) for key, c in counts if c]
    n_docs, n_all = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        asked, scored = Counter(terms(text)), []
        for key, c in counts:
            m = 75 + 25 * sum(c.values()) * n_docs // n_all
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, k in asked.items() if c[t])
            if score > 0:
                scored.append((-score, key is None, key))
        out += [(item, i + 1, key, -s) for i, (s, _, key) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:most])]
    return out


def archived(pages, least=1000):
    """(id, bytes, digest, type, refers to) of (id, html) rows."""
    last = {}
    for key, html in pages:
        raw = (html or "").encode()
        if key is not None and len(raw) >= least:
            last[raw] = max(key, last.get(raw, key))
    out = []
    for key, html in pages:
        raw = (html or "").encode()
        first = last.get(raw, key)
        out.append((key, len(raw), hashlib.sha1(raw).hexdigest(), "response" if first == key else "revisit", None if first == key else first))
    return out
