"""Plain versions of the operators' contracts, for small tables."""

import hashlib
import os
import re
from collections import Counter, defaultdict

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.01")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def listed(spans, kinds):
    return ",".join(f"{k}:{s}:{e}" for s, k, e in sorted(spans, key=lambda x: (x[0], kinds.index(x[1]))))


def secrets(text):
    text = text or ""
    out = [(m.start(), "assign", m.end()) for m in re.finditer(
        r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text) if len(m.group(2)) >= 6]
    out += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    return out + [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 24]


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def personal(text):
    text = text or ""
    out = [(m.start(), "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), "phone", m.end()))
    return out


def repeats(texts, length=200):
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return out


class Union:
    def __init__(self):
        self.root = {}

    def find(self, x):
        self.root.setdefault(x, x)
        while self.root[x] != x:
            x = self.root[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.root[max(a, b)] = min(a, b)


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def near_duplicates(rows, percent=85):
    """id -> (set size, component)."""
    sets = {i: shingles(t) for i, t in rows}
    union, ids = Union(), sorted(sets)
    index = defaultdict(list)
    for i in ids:
        for s in sets[i]:
            index[s].append(i)
    for i in ids:
        for j, common in Counter(j for s in sets[i] for j in index[s] if j > i).items():
            if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                union.join(i, j)
    return {i: (len(sets[i]), union.find(i)) for i in ids}


def contaminated(docs, items, window=10):
    """id -> (n_words, n_hit, item ids)."""
    def words(text):
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)

    grams = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if w else ():
            grams[tuple(w[i:i + n])].add(item)
    out = {}
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for s in range(len(w) - n + 1):
                g = tuple(w[s:s + n])
                if g in grams:
                    hit.update(range(s, s + n))
                    found |= grams[g]
        out[i] = (len(w), len(hit), sorted(map(str, found)))
    return out
