"""Plain-Python versions of the operators, one row or pair at a time."""
import base64
import hashlib
import math
import re
from collections import Counter

SPACES = b" \t\n\v\f\r"


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, k):
    w = words(text)
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([tuple(w)] if w else [])


def groups(rows, k, percent=80):
    """id -> (number of shingles, smallest id reachable over similar pairs); all pairs."""
    sets = {i: frozenset(shingles(t, k)) for i, t in rows}
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), top(i)) for i in sets}


def dedup_lines(rows, min_chars=10, min_docs=2):
    """id -> (lines, dropped, kept text) for rows with distinct ids."""
    def key(line):
        k = line.strip(SPACES).lower()
        return k if len(k.decode()) >= min_chars else None

    holders = {}
    for i, t in rows:
        for line in (t or "").encode().split(b"\n"):
            if i is not None and key(line) is not None:
                holders.setdefault(key(line), set()).add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").encode().split(b"\n")
        kept = [x for x in lines if i is None or key(x) is None or len(holders[key(x)]) < min_docs or i == min(holders[key(x)])]
        out[i] = (len(lines), len(lines) - len(kept), b"\n".join(kept).decode())
    return out


def contaminated(rows, items, k=5, percent=80):
    """(id, item) -> best similarity over all windows of the item's length."""
    counts = {i: Counter(shingles(t, k)) for i, t in items if words(t)}
    out = {}
    for d, t in rows:
        s = shingles(t, k)
        for i, c in counts.items():
            n = c.total()
            size = min(n, len(s))
            best = 0
            if not c.keys() & set(s):
                continue
            for a in range(len(s) - size + 1 if s else 0):
                common = (Counter(s[a:a + size]) & c).total()
                best = max(best, common / (size + n - common))
            if 100 * best >= percent:
                out[d, i] = best
    return out


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
       "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text):
    """Sorted (start, kind number, end)."""
    out = []
    for n, (kind, pattern) in enumerate(PII.items()):
        for m in re.finditer(pattern, text or ""):
            v, d = m.group(), re.sub("[^0-9]", "", m.group())
            good = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in v.split(".")),  # noqa: B023
                    "card": lambda: 12 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]()  # noqa: B023
            if good:
                out.append((m.start(), n, m.end()))
    return sorted(out)


def digest(spans):
    return ",".join(f"{[*PII, 'term'][k]}:{s}:{e}" for s, k, e in spans)


def base32_sha1(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def unigram(rows, held):
    """id -> (tokens, known, all training tokens, add-one log10 probability)."""
    tokens = {i: words(t) + [None] for i, t in rows}
    c = Counter(x for i in tokens if not held(i) for x in tokens[i])
    n, v = c.total(), len(c)
    return {i: (len(t), sum(c[x] > 0 for x in t), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t)) for i, t in tokens.items()}


def greedy(word, initial, continuation):
    """Number of longest-match pieces, 0 where none fits."""
    n = at = 0
    while at < len(word):
        vocabulary = continuation if at else initial
        end = next((e for e in range(min(len(word), at + 9), at, -1) if word[at:e] in vocabulary), None)  # no test piece is longer
        if end is None:
            return 0
        n, at = n + 1, end
    return n
