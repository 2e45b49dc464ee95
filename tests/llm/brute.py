"""Plain statements of what the operators return, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _marked(sequences, window):
    seen = Counter(s[i:i + window] for s in sequences for i in range(len(s) - window + 1))
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - window + 1):
            if seen[s[i:i + window]] > 1:
                gone[i:i + window] = [True] * window
        yield s, gone


def repeated_bytes(texts, window=200):
    for b, gone in _marked([(t or "").encode() for t in texts], window):
        runs = len(re.findall("1+", "".join("01"[g] for g in gone)))
        yield len(b), sum(gone), runs, sha(bytes(x for x, g in zip(b, gone) if not g))


def repeated_words(texts, window=35):
    for w, gone in _marked([tuple(WORD.findall(t or "")) for t in texts], window):
        yield len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g).encode())


def shingles(text, k=4):
    w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def jaccard_components(rows, percent=85):
    """rows of (doc_id, text) -> per row (size, least doc_id reachable)."""
    sets = [shingles(t) for _, t in rows]
    home = {d: d for d, _ in rows}

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(rows[i][0]), find(rows[j][0])
                home[max(x, y)] = min(x, y)
    return [(len(s), find(d)) for s, (d, _) in zip(sets, rows)]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def personal(text):
    """Base spans by kind."""
    def good(kind, m):
        d = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")),
                "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
    return {k: [m.span() for m in re.finditer(p, text or "") if good(k, m[0])] for k, p in KINDS.items()}


def weighted_shingles(text, k=5):
    w = WORD.findall(text or "")
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else Counter([tuple(w)] if w else [])


def url_rule(url, rules):
    url = url or ""
    at = url.find("://")
    rest = url[at + 3:] if at >= 0 else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(raw):])[0]
    host = re.sub("[A-Z]+", lambda m: m[0].lower(), raw)
    best = None
    for verdict, rule in rules:
        own, slash, tail = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + tail):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return host, path, best


def grouped(rows, key):
    out = defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out


def periodic_runs(words, least=6, exponent=4):
    """(start, length, period) of every maximal run, by start, then period."""
    out = set()
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q) and not any(
                    all(words[x] == words[x + p] for x in range(i, j + q - p)) for p in range(1, q)):
                out.add((i, j + q - i, q))
            i = j + 1
    return sorted(out)


def edited_words(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if doc_id is None or h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def runs_digest(doc_id, text):
    w = edited_words(doc_id, text)
    runs = periodic_runs(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return (doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(" ".join(x for i, x in enumerate(w) if i not in gone).encode()))


def audit(rows, labels):
    """rows of (doc_id, text, lang), labels {doc_id: (quality, toxic)} -> rows of the audit."""
    first = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    parts = defaultdict(list)
    for d, t, lang in rows:
        t = t or ""
        w = WORD.findall(t)
        failed = {f for f, bad in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search("[#$%&*|]", t)), d is not None and first[t] < d)) if bad}
        parts[lang or ""].append((failed, *labels.get(d, (0, 0))))
    out = []
    for part, docs in parts.items():
        shapley = Counter()
        own = []
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                shapley[f] += len(gone)
                own.append([part, "".join(order), step, len(left), len(gone), sum(f in x[0] for x in docs) - len(gone),
                            sum(x[0] == {f} for x in docs), sum(x[1] == 1 for x in gone), sum(x[2] == 1 for x in gone)])
        out += [(*x, shapley[x[1][x[2] - 1]]) for x in own]
    return out


def exact_copies(rows, largest=True):
    groups = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        groups[t or ""].append((d is not None, (d or 0) if largest else -(d or 0), -i))
    stays = {t: max(g) for t, g in groups.items()}
    return [(d, rows[-stays[t or ""][2]][0], len(groups[t or ""]), -stays[t or ""][2] == i, sha((t or "").encode()))
            for i, (d, t) in enumerate(rows)]
