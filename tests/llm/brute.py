"""Plain-Python references for the training-data operators."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(s):
    return hashlib.sha256(s if isinstance(s, bytes) else s.encode()).hexdigest()


def substring_dedup(rows, n=13):
    """rows: (doc_id, text); returns {doc_id: (n_words, n_removed, kept_sha256)}."""
    first = {}
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in words:
        if i is not None:
            for k in range(len(w) - n + 1):
                g = tuple(w[k : k + n])
                first[g] = min(first.get(g, i), i)
    out = {}
    for i, w in words:
        gone = [False] * len(w)
        if i is not None:
            for k in range(len(w) - n + 1):
                if first[tuple(w[k : k + n])] < i:
                    gone[k : k + n] = [True] * n
        kept = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), sum(gone), sha(" ".join(kept)))
    return out


def byte_dedup(rows, n=400):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}; every string of n bytes that starts twice anywhere goes."""
    seen = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        for k in range(len(b) - n + 1):
            g = b[k : k + n]
            seen[g] = seen.get(g, 0) + 1
    out = {}
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if seen[b[k : k + n]] > 1:
                gone[k : k + n] = b"\1" * n
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))
    return out


def jaccard_components(rows, n=5, num=80):
    """{doc_id: (n_shingles, component_id)}."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(low))
        sets.append((i, {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by = {}
    for k, (_, s) in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(k)
    tried = set()
    for group in by.values():
        for a in range(len(group)):
            for b in range(a + 1, len(group)):
                p = (group[a], group[b])
                if p not in tried:
                    tried.add(p)
                    x, y = sets[p[0]][1], sets[p[1]][1]
                    if min(len(x), len(y)) * 100 >= num * max(len(x), len(y)) and 100 * len(x & y) >= num * len(x | y):
                        parent[find(p[0])] = find(p[1])
    least = {}
    for k, (i, _) in enumerate(sets):
        r = find(k)
        least[r] = min(least.get(r, i), i)
    return {i: (len(s), least[find(k)]) for k, (i, s) in enumerate(sets)}


def spark_hash(*values):
    """xxhash64 of longs, strings and lists of longs as Spark chains them; a null leaves the hash as it is."""
    import xxhash

    h = 42
    for v in values:
        for x in v if isinstance(v, list) else [v]:
            if x is not None:
                h = xxhash.xxh64_intdigest(x.encode() if isinstance(x, str) else (x & MASK).to_bytes(8, "little"), h)
    return signed(h)


MASK = (1 << 64) - 1


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def imatch(rows, subsets, min_share, max_share):
    """rows: (doc_id, text), distinct; {(doc_id, text): (n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)}."""
    from math import ceil

    terms = lambda t: {w for w in re.split(r"[\x20\x09-\x0D]+", t.lower()) if w}
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), spark_hash(r[1])))
    df = {}
    for _, t in order:
        for w in terms(t):
            df[w] = df.get(w, 0) + 1
    n = len(order)
    lex = {spark_hash(w) for w, c in df.items() if max(2, ceil(n * min_share)) <= c <= ceil(n * max_share)}

    def prints(t):
        found = sorted(lex & {spark_hash(w) for w in terms(t)})
        out = []
        for d, m in subsets:
            for k in range(m):
                if not out:
                    part = found
                elif d == 1:
                    part = [x for x in found if (x >> 57) % 8 != k]
                else:
                    part = [x for x in found if (x >> (2 * k + 1)) % d == 0]
                out.append(spark_hash(part) if part else None)
        out[0] = spark_hash(t) if out[0] is None else out[0]
        return out

    def likeness(a, b):
        told = [x == y for x, y in zip(a, b) if x is not None or y is not None]
        return sum(told) / len(told)

    text = lambda p: ".".join("-" if x is None else f"{x & MASK:x}" for x in p)
    got = {}
    for k, (i, t) in enumerate(order):
        nxt, h = order[(k + 1) % n][1], len(t) // 2
        edited = t[: len(t) - h] + nxt[:h]
        a, b, c = prints(t), prints(edited), prints(nxt)
        got[i, t] = (len(t), sha(edited), text(a), text(b), likeness(a, b), likeness(a, c))
    return got


def mixed(rows, weights, most, block, shards, seed):
    """rows: (doc_id, source, text) of one stretch; [(doc_id, source, size, target, taken)], blocks laid out and counted one by one."""
    import numpy as np

    from tipoff.llm import mixing

    rows = sorted(((i, s, len(WORD.findall(t or "")), spark_hash(i, t or "")) for i, s, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[3]))
    names = sorted({r[1] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(r[2] for r in rows if r[1] == s) for s in names}
    goal = dict(zip(names, mixing.targets([total[s] for s in names], [weights[k % len(weights)] for k in range(len(names))], most)))
    blocks = {s: -(-total[s] // block) for s in names}
    slots = [max(min(round(goal[s] / block), most * blocks[s]), 1) if blocks[s] else 0 for s in names]
    assert mixing.draw(slots, shards, seed).sum(0).tolist() == slots  # shards deal out all slots
    out = []
    for k, s in enumerate(names):
        words = [(j, w) for j, r in enumerate(rows) if r[1] == s for w in range(r[2])]
        times = [0] * blocks[s]
        for i in range(slots[k]):
            key = mixing.mix(np.array([(k * 0x9E3779B97F4A7C15 + seed & MASK) + i // blocks[s] & MASK], np.uint64))
            times[int(mixing.permuted(np.array([i % blocks[s]]), np.array([blocks[s]]), key)[0])] += 1
        taken = {}
        for at, (j, _) in enumerate(words):
            taken[j] = taken.get(j, 0) + times[at // block]
        out += [(r[0], s, r[2], goal[s], taken.get(j, 0)) for j, r in enumerate(rows) if r[1] == s]
    return out


def contamination(rows, items, window=10, near_terms=4, within=20):
    """rows: texts; items: (item_id, text); [(n_words, n_hit, sorted item_ids, near item_ids)] in the order of rows."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(low))
    windows, bags = {}, {}
    for i, t in items:
        w = find(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add(i)
        if w and i is not None:
            bags.setdefault(str(i), set()).update(w)
    texts = [find(t) for t in rows]
    count = {}
    for w in texts:
        for x in w:
            count[x] = count.get(x, 0) + 1
    rare = {i: sorted(b, key=lambda x: (count.get(x, 0), x.encode()))[:near_terms] for i, b in bags.items()}
    sizes = {len(g) for g in windows}
    out = []
    for w in texts:
        hit, named = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                g = tuple(w[k : k + n])
                if g in windows:
                    hit.update(range(k, k + n))
                    named |= {str(i) for i in windows[g] if i is not None}
        near = {i for i, terms in rare.items() if any(set(terms) <= set(w[k : k + within]) for k in range(len(w)))}
        out.append((len(w), len(hit), sorted(named), sorted(near)))
    return out
