"""Plain versions of the operators, written from their contracts."""

import hashlib
import re

import xxhash

WORDS7 = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def lower(text):
    return re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())


def repeated_bytes(docs, length=50):
    least = {}
    for d, t in docs:
        b = (t or "").encode()
        for i in range(len(b) - length + 1) if d is not None else ():
            w = b[i : i + length]
            least[w] = min(d, least.get(w, d))
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1) if d is not None else ():
            if least[b[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        spans = [x for x in bytes(gone).split(b"\0") if x]
        out.append((d, len(b), sum(gone), len(spans), hashlib.sha256(bytes(x for x, y in zip(b, gone) if not y)).hexdigest()))
    return out


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(docs, threshold=4, similar=False):
    """Linked by fingerprints, and with ``similar`` also by a Jaccard similarity of five-word shingles of 0.8."""
    fps = [fingerprint(t) for _, t in docs]
    words = [re.findall(rb"[^\x20\x09-\x0D]+", lower(t)) for _, t in docs]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= threshold or (similar and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(docs)]


def hits(docs, items, window=13):
    windows = {}
    for i, t in items:
        w = WORDS7.findall(lower(t))
        for a in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[a : a + window]), set()).add(i)
    out = []
    for d, t in docs:
        w = WORDS7.findall(lower(t))
        hit, found = [0] * len(w), set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[a : a + n]))) is not None:
                    found |= own
                    hit[a : a + n] = [1] * n
        names = sorted(str(x) for x in found if x is not None)
        out.append((d, len(w), sum(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return out


def secrets(text):
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return ",".join(x for _, _, x in sorted(found))


def without_boilerplate(docs, sites=8):
    site_of, on = {}, {}
    for _, t, s in docs:
        if s is not None:
            site_of[t or ""] = min(s, site_of.get(t or "", s))
    for t, s in site_of.items():
        for line in t.split("\n"):
            on.setdefault(line, set()).add(s)
    out = []
    for d, t, _ in docs:
        lines = (t or "").split("\n")
        full = [bool(re.search(r"[^ \t\x0B\f\r]", x)) for x in lines]
        left = [x for x, f in zip(lines, full) if not (f and len(on.get(x, ())) >= sites)]
        out.append((d, sum(full), len(lines) - len(left), "\n".join(left)))
    return out


def clean_lines(docs, sites=8):
    """(doc_id, text) without boilerplate, where copies and near copies of a text (five-word shingles, Jaccard 0.8) count as one site."""
    first = {d[1]: w for d, w in zip(docs, without_boilerplate(docs, sites))}
    shingles = {}
    for t, w in first.items():
        if t and 2 * len(w[3]) < len(t):
            words = re.findall(r"[^ \t\n\x0B\f\r]+", t)
            shingles[t] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    root = {t: t for t in first}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in shingles:
        for b in shingles:
            if a < b and len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]):
                root[find(a)] = find(b)
    site_of, on = {}, {}
    for _, t, s in docs:
        if s is not None:
            site_of[find(t)] = min(s, site_of.get(find(t), s))
    for t in first:
        for line in (t or "").split("\n") if find(t) in site_of else ():
            on.setdefault(line, set()).add(site_of[find(t)])
    keep = lambda x: not (re.search(r"[^ \t\x0B\f\r]", x) and len(on.get(x, ())) >= sites)
    return [(d, t if t is None else "\n".join(filter(keep, t.split("\n")))) for d, t, _ in docs]
