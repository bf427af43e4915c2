"""Plain-Python versions of the operators, for small tables."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def words(t: str | None) -> list[str]:
    return WORD.findall(t or "")


def exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t or "")].append(i)
    out = []
    for i, t in rows:
        ids = groups[lower(t or "")]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(lower(t or "").encode()).hexdigest()))
    return out


def gram_set(t, width):
    w = words(lower(t or ""))
    return {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def components(rows, width, percent):
    """Components of (id, text) rows; ids of rows may repeat."""
    sets, parent = [gram_set(t, width) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        if i is not None and (least.get(r) is None or i < least[r]):
            least[r] = i
    return [(i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)]


def covered(symbols, length):
    """For (id, symbols) rows: the mask of what windows of smaller ids cover. A null id is largest."""
    big = 2**63 - 1
    first = {}
    for i, s in symbols:
        for k in range(len(s) - length + 1):
            key = s[k:k + length] if isinstance(s, bytes) else tuple(s[k:k + length])
            first[key] = min(first.get(key, big), big if i is None else i)
    out = []
    for i, s in symbols:
        mask = [False] * len(s)
        for k in range(len(s) - length + 1):
            key = s[k:k + length] if isinstance(s, bytes) else tuple(s[k:k + length])
            if first[key] < (big if i is None else i):
                mask[k:k + length] = [True] * length
        out.append(mask)
    return out


def suffix(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    out = []
    for (i, b), m in zip(texts, covered(texts, length)):
        spans = sum(x and (k == 0 or not m[k - 1]) for k, x in enumerate(m))
        out.append((i, len(b), sum(m), spans, hashlib.sha256(bytes(x for x, y in zip(b, m) if not y)).hexdigest()))
    return out


def substring(rows, length):
    texts = [(i, words(t)) for i, t in rows]
    return [(i, len(w), sum(m), hashlib.sha256(" ".join(x for x, y in zip(w, m) if not y).encode()).hexdigest())
            for (i, w), m in zip(texts, covered(texts, length))]


def leaks(rows, items, span, mismatches, min_words=5):
    """Whether each row holds an aligned stretch of an item."""
    items = [words(lower(t or "")) for _, t in items]
    out = []
    for i, t in rows:
        w, bad = words(lower(t or "")), False
        for x in items:
            n, most = (span, mismatches) if len(x) >= span else (len(x), 0)
            if len(x) < min_words:
                continue
            bad = bad or any(sum(p != q for p, q in zip(w[a:a + n], x[b:b + n])) <= most
                             for a in range(len(w) - n + 1) for b in range(len(x) - n + 1))
        out.append((i, bad))
    return out


def targets(sizes: dict, weights, limit):
    """Resharing by rounds: sources above their cap are set to it, the excess goes to the others."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, capped, total = {}, set(), float(sum(sizes.values()))
    while True:
        rest = total - sum(limit * sizes[s] for s in capped)
        wsum = sum(w[s] for s in order if s not in capped)
        target = {s: limit * sizes[s] if s in capped else rest * w[s] / wsum for s in order}
        over = {s for s in order if s not in capped and target[s] > limit * sizes[s]}
        if not over:
            return target
        capped |= over


def warc(pages, revisit_from=0):
    first, out = {}, []
    for i, h in pages:
        b = (h or "").encode()
        first.setdefault(b, []).append(i)
    for i, h in pages:
        b = (h or "").encode()
        least = min((x for x in first[b] if x is not None), default=None)
        revisit = len(b) >= revisit_from and least is not None and i != least
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if revisit else "response", least if revisit else None))
    return out


def trie(turns, rebuild=True):
    """Nodes of the conversation trie; ``turns`` are (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            told = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            convs[c].append(((turn is not None, turn or 0), told, (role, text)))
    for c in convs:
        convs[c] = [x[2] for x in sorted(convs[c])]
    paths = dict(convs)
    if rebuild:
        for c, own in convs.items():
            h = zlib.crc32(str(c).encode()) % 6
            paths[c] = convs.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(paths):
        p = tuple(paths[c])
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
        ends[p].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return [(m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
             hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items()]


def collocations(rows, min_count=10, percent=50, top=2000):
    """Rows of (lang, rank, phrase, a, l, r, n, score); ``rows`` are (lang, text)."""
    f, n = defaultdict(int), defaultdict(int)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    found = defaultdict(list)
    for (lang, g), a in f.items():
        if len(g) == 1 or a < min_count:
            continue
        cuts = [(10 ** 6 * a * a // (f[lang, g[:k]] * f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        if len(g) == 2 and any(b >= min_count and 100 * b >= percent * a for (x, h), b in f.items()
                               if x == lang and len(h) == 3 and (h[:2] == g or h[1:] == g)):
            continue
        found[lang].append((-score, -a, " ".join(g).encode(), f[lang, g[:k]], f[lang, g[k:]]))
    return [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang in found for i, (s, a, p, l, r) in enumerate(sorted(found[lang])[:top])]
