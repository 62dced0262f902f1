"""Plain Python versions of the operators' contracts, for small tables."""

import hashlib
import math
import re
import zlib


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def contamination(docs, items):
    word = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for i, t in items:
        w = word.findall(lower(t))
        n = min(13, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[a:a + n]), set()).add(i)
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w = word.findall(lower(t))
        hit, found = set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                own = windows.get(tuple(w[a:a + n]))
                if own:
                    found |= own
                    hit |= set(range(a, a + n))
        names = ",".join(sorted(map(str, found)))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def shingle_sets(docs, size):
    out = []
    for d, t in docs:
        w = re.findall("[^\x20\x09-\x0D]+", lower(t))
        n = min(size, len(w))
        out.append((d, frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if n else frozenset()))
    return out


def components(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {i: root(i) for i in ids}


def near_duplicates(docs, size=3, top=85, bottom=100):
    """All pairs that share a shingle are compared."""
    sets = shingle_sets(docs, size)
    where, links = {}, []
    for i, (_, s) in enumerate(sets):
        met = {}
        for x in s:
            for j in where.setdefault(x, []):
                met[j] = met.get(j, 0) + 1
            where[x].append(i)
        for j, both in met.items():
            if bottom * both >= top * (len(s) + len(sets[j][1]) - both):
                links.append((sets[i][0], sets[j][0]))
    name = components([d for d, _ in sets], links)
    return [(d, len(s), name[d], name[d] == d) for d, s in sets]


def embedding_links(rows, threshold=0.93):
    import numpy as np
    usable = {}
    for i, v, label in rows:
        if label is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v):
            usable.setdefault((label, len(v)), []).append((i, np.array(v, float)))
    count, links = {}, []
    for own in usable.values():
        ids = [i for i, _ in own]
        m = np.array([v for _, v in own])
        m /= np.sqrt((m * m).sum(1))[:, None]
        for a, i in enumerate(ids):
            near = np.flatnonzero(m @ m[a] >= threshold)
            links += [(i, ids[b]) for b in near if b != a]
            count[i] = count.get(i, 0) + len(near) - 1
    name = components([i for i, _, _ in rows], links)
    return [(i, count.get(i, 0), name[i], name[i] == i) for i, _, _ in rows]


def unigram_scores(docs):
    import math
    from collections import Counter
    words = {d: re.findall("[^\x20\x09-\x0D]+", lower(t)) + [None] for d, t in docs}
    count = Counter(w for d, own in words.items() if crc(d) % 7 != 2 for w in own)
    n, v = sum(count.values()), len(count)
    return [(d, crc(d) % 7 == 2, len(own), sum(count[w] > 0 for w in own), n,
             sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)) for d, own in words.items()]


def hard_negatives(rows, anchors, positives=5, negatives=5):
    """rows: (id, label, vector); usable rows only, one per id."""
    import numpy as np
    whole = {i: np.floor(256 * np.array(v, float)).astype(np.int64) for i, _, v in rows}
    label = {i: c for i, c, _ in rows}
    out = []
    for a in anchors:
        score = {i: int(whole[a] @ w) for i, w in whole.items() if i != a and len(w) == len(whole[a])}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if label[i] == label[a]][:positives]:
            fits = [i for i in order if label[i] != label[a] and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(fits[:negatives])]
    return out


def neighbours(rows, queries, k=10):
    """rows: (id, vector); usable rows only, one per id."""
    import numpy as np
    out = []
    for q, centre in rows:
        if q in queries:
            far = []
            for i, v in rows:
                if i != q and len(v) == len(centre):
                    total = 0.0
                    for step in np.array(v, float) - np.array(centre, float):
                        total += step * step
                    far.append((math.sqrt(total), i))
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(sorted(far)[:k])]
    return out


def spelling_variants(docs, length=5, least=3):
    """Near words by deleting each letter of every word, and replacing each by a gap."""
    from collections import Counter, defaultdict
    count = Counter()
    for d, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", lower(t)):
            h = zlib.crc32(f"{d}:{w}".encode()) if d is not None else 1
            if h % 97 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1:]
            count[w] += 1
    count = {w: n for w, n in count.items() if len(w) >= length and n >= least}
    holes = defaultdict(set)
    for w in count:
        for i in range(len(w)):
            holes[w[:i] + "?" + w[i + 1:]].add(w)
    near = defaultdict(set)
    for own in holes.values():
        for w in own:
            near[w] |= own - {w}
    for w in count:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1:]
            if shorter in count:
                near[w].add(shorter)
                near[shorter].add(w)
    form = {}
    for w, n in count.items():
        best = min(near[w], key=lambda x: (-count[x], x), default=None)
        form[w] = best if best is not None and count[best] >= 2 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return [(w, form[w], root(w), n, len(near[w]), count.get(form[w])) for w, n in count.items()]
