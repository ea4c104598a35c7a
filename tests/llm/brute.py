"""Plain statements of the contracts, for small inputs."""

import collections
import hashlib
import re

import numpy as np
import xxhash

SPACE = r"[^\x20\x09-\x0D]+"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base_spans(text):
    text, out = text or "", []
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in ("password", "passwd", "secret", "token"))
    for m in re.finditer(rf"({key}|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def spans_sha(text):
    return hashlib.sha256(",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in base_spans(text)).encode()).hexdigest()


def removed(docs):
    """docs: [(doc_id, text)], ids distinct -> {doc_id: (n_words, n_removed, sha)}"""
    words = {i: re.findall(SPACE, t or "") for i, t in sorted(docs)}
    first, out = {}, {}
    for i, w in words.items():
        for k in range(len(w) - 19):
            first.setdefault(tuple(w[k : k + 20]), (i, k))
    for i, w in words.items():
        cut = [False] * len(w)
        for k in range(len(w) - 19):
            if first[tuple(w[k : k + 20])] != (i, k):
                cut[k : k + 20] = [True] * 20
        kept = [x for x, c in zip(w, cut, strict=True) if not c]
        out[i] = (len(w), sum(cut), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def contamination(text, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(t))
    w, hit, found = split(text), set(), set()
    for item_id, t in items:
        v = split(t)
        m = min(len(v), 13)
        wins = {tuple(v[i : i + m]) for i in range(len(v) - m + 1)} if v else set()
        for s in range(len(w) - m + 1) if m else ():
            if tuple(w[s : s + m]) in wins:
                hit |= set(range(s, s + m))
                found.add(str(item_id))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def counts(text):
    t = text or ""
    w = re.findall(SPACE, t)
    seen, dup, cover = set(), 0, set()
    for line in t.split("\n"):
        if re.search(SPACE, line):
            dup += line in seen
            seen.add(line)
    c = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    for i in range(len(w) - 2):
        if c[w[i], w[i + 1], w[i + 2]] > 1:
            cover |= {i, i + 1, i + 2}
    failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover), failed


def fingerprint(text):
    w = re.findall(SPACE, low(text))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, distance=3):
    """{fingerprint: root} of the links at up to ``distance`` bits."""
    u = np.unique(np.array(fps, dtype=np.uint64))
    parent = list(range(len(u)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(u)):
        for j in np.nonzero(np.bitwise_count(u[i + 1 :] ^ u[i]) <= distance)[0]:
            parent[root(i + 1 + int(j))] = root(i)
    return {int(x): root(i) for i, x in enumerate(u)}


RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def url_rule(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = low(host)
    best = None
    for rule in RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best)):
            best = rule
    return host, path, best
