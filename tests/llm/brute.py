"""Plain versions of the operators, for small inputs: one document after the other,
all pairs, no hashing tricks."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


# --- quality rules --------------------------------------------------------------

def rule_measures(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(windows)
    under = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)),
            "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(under),
            "base_failed": len(w) < 10 or 100 * len(under) > 20 * len(w)}


# --- repeated substrings --------------------------------------------------------

def without_repeats(docs, length=50):
    """docs: (id, text). Ids are compared as numbers, null after all."""
    first = {}
    order = lambda d: float("inf") if d is None else d     # noqa: E731
    for doc, text in docs:
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            s = raw[i:i + length]
            first[s] = min(first.get(s, float("inf")), order(doc))
    out = []
    for doc, text in docs:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first[raw[i:i + length]] < order(doc):
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


# --- simhash --------------------------------------------------------------------

def fingerprint(text, k=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(text)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(codes, most=3):
    """Index of the first member of each code's component, by all pairs."""
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= most:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(codes))]


def simhash_components(docs, k=3, most=3):
    codes = [fingerprint(t, k) for _, t in docs]
    roots = linked(codes, most)
    low = defaultdict(list)
    for (doc, _), r in zip(docs, roots):
        low[r].append(doc)
    return [(doc, f"{c:016x}", min((d for d in low[r] if d is not None), default=None))
            for (doc, _), c, r in zip(docs, codes, roots)]


# --- personal data --------------------------------------------------------------

PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
       "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
       "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d)
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def personal(text):
    spans = []
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            spans.append((kind, m.start(), m.end()))
    return spans


# --- mixing ---------------------------------------------------------------------

def source_targets(sizes, weights=(5, 2, 1), most=3):
    """sizes: source -> size. Shared again and again until none is above its stop."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in stopped]
        rest = total - sum(stopped.values())
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free} if free else {}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**stopped, **share}
        stopped |= {s: most * sizes[s] for s in over}


# --- packing --------------------------------------------------------------------

def pieces_are_right(docs, pieces, ids_of):
    """Every id of every document in exactly one piece; sequences without gaps."""
    ids = {}
    for doc, text in docs:
        ids.setdefault(doc, []).append(ids_of(text))
    left = {d: sorted(map(len, x)) for d, x in ids.items()}
    seen = defaultdict(list)
    sequences = defaultdict(list)
    for p in pieces:
        options = [x for x in ids[p["doc_id"]] if len(x) == p["doc_tokens"]]
        want = {zlib.crc32(b"".join(i.to_bytes(4, "little") for i in x[p["start"]:p["start"] + p["length"]]))
                for x in options}
        assert p["ids_crc32"] in want
        assert p["length"] > 0
        seen[p["doc_id"]] += range(p["start"], p["start"] + p["length"])
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for doc, sizes in left.items():
        assert sorted(seen[doc]) == sorted(i for n in sizes for i in range(n))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        if at & (at - 1):
            padding += 2048 - at
    return padding


# --- top k ----------------------------------------------------------------------

def top_k(rows, k, every):
    """rows: (id, vector)."""
    import math
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(whole):      # a query is a row: its copies are candidates
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, v)), i) for m, (i, v) in enumerate(whole)
                            if m != n and len(v) == len(a))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


# --- urls -----------------------------------------------------------------------

def url_parts(url):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def url_rule(host, path, rules):
    best = None
    for verdict, rule in rules:
        name, tail = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            best = max(best or (0, "", ""), (len(rule), rule, verdict))
    return best[1:] if best else (None, None)
