"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import xxhash


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def quality(text):
    ws, text = words(text), text or ""
    grams = Counter(zip(ws, ws[1:], ws[2:]))
    hit = {j for i in range(len(ws) - 2) if grams[tuple(ws[i:i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(hit))


def simhash(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    ws = words(low)
    grams = [" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))] if ws else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def near_components(rows, distance):
    """Smallest id reachable, by row; ``rows`` are (doc_id, fingerprint)."""
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= distance and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return [min((rows[j][0] for j in range(len(rows)) if label[j] == label[i]
                 and rows[j][0] is not None), default=None) for i in range(len(rows))]


def passages(rows, window=13):
    """(words, removed, sha256) by row; ``rows`` are (doc_id, text)."""
    first = {}
    for doc, text in rows:
        ws = words(text)
        for i in range(len(ws) - window + 1):
            if doc is not None:
                key = tuple(ws[i:i + window])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        ws = words(text)
        gone = {j for i in range(len(ws) - window + 1)
                if doc is not None and first[tuple(ws[i:i + window])] < doc
                for j in range(i, i + window)}
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((doc, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def byte_repeats(rows, length):
    raws = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(r[i:i + length] for _, r in raws for i in range(len(r) - length + 1))
    out = []
    for doc, raw in raws:
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(raw) else 0
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc, len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def ranked(rows, items, k=20):
    """(item_id, rank, doc_id, score); ``rows`` are (doc_id, text), ``items`` (item_id, text)."""
    def terms(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)

    docs = [(d, Counter(terms(t))) for d, t in rows]
    docs = [(d, c) for d, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(w for _, c in docs for w in c)
    out = []
    for item, text in items:
        found = []
        for d, c in docs:
            m = 75 + 25 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                        * (10 ** 9 * c[w] // (1000 * c[w] + 12 * m)) for w in terms(text) if w in c)
            if score > 0:
                found.append((-score, d is None, d or 0))
        for i, (score, none, d) in enumerate(sorted(found)[:k]):
            out.append((item, i + 1, None if none else d, -score))
    return out


def shingle_sets(rows, size=2):
    out = []
    for _, text in rows:
        ws = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append({tuple(ws[i:i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set())
    return out


def jaccard_components(rows, percent=80):
    """(doc_id, set size, smallest id reachable) by row."""
    sets = shingle_sets(rows)
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return [(rows[i][0], len(sets[i]),
             min((rows[j][0] for j in range(len(rows)) if label[j] == label[i]
                  and rows[j][0] is not None), default=None)) for i in range(len(rows))]


def lattice_scores(rows, pieces, p, train, rounds=3, prior=1000.0):
    """log10 probability of every text: expectation-maximisation over all segmentations of the training
    words into ``pieces`` (name: id) or bytes (ids after them), then the sum over all segmentations.
    ``p`` holds the starting probabilities, the end's last; ``rows`` are (doc_id, text)."""
    first_byte, longest = len(p) - 257, max(map(len, pieces))

    def arcs(text):
        for j in range(1, len(text) + 1):
            yield j - 1, j, [first_byte + b for b in text[j - 1].encode()]
            for i in range(max(0, j - longest), j):
                if text[i:j] in pieces:
                    yield i, j, [pieces[text[i:j]]]

    def forward(text, p):
        f = [1.0] + [0.0] * len(text)
        for i, j, ids in arcs(text):
            f[j] += f[i] * math.prod(p[k] for k in ids)
        return f

    def low(text):
        return words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    seen = Counter(w for i, (_, t) in enumerate(rows) if train[i] for w in low(t))
    now = list(p)
    for _ in range(rounds):
        use = [prior * x for x in p]
        for w, c in seen.items():
            text = "\u2581" + w
            f, b = forward(text, now), [0.0] * len(text) + [1.0]
            for i, j, ids in sorted(arcs(text), key=lambda a: -a[1]):
                b[i] += b[j] * math.prod(now[k] for k in ids)
            for i, j, ids in arcs(text):
                share = c * f[i] * math.prod(now[k] for k in ids) * b[j] / f[-1]
                for k in ids:
                    use[k] += share
        use[-1] += sum(train)
        now = [x / sum(use) for x in use]
    return [sum(math.log10(forward("\u2581" + w, now)[-1]) for w in low(t)) + math.log10(now[-1])
            for _, t in rows]
