"""Vector codes and centroid clustering against plain whole-number versions."""

import hashlib
import math

import numpy as np
import pytest

from tipoff.llm import _common, centroids, codes, integers

SCHEMA = "vec_id long, embedding array<double>, label int, code string, cluster int"
NONE = float("nan"), float("inf"), float("-inf"), None


def vectors(n, dim, seed=0, clusters=0):
    g = np.random.default_rng(seed)
    x = g.standard_normal((n, dim)) / 8
    if clusters:
        x = x / 40 + (g.standard_normal((clusters, dim)) / 3)[np.arange(n) % clusters]
    return [(i * 7 % 1009 + 1009 * (i // 1009), v) for i, v in enumerate(x.tolist())]


def frame(spark, rows):
    """Rows with labels (some null), and rows that take no part."""
    dim = len(rows[0][1]) if rows else 4
    bad = [(9000 + k, [z] + [0.5] * (dim - 1)) for k, z in enumerate(NONE)] + [(9010, None), (9011, []), (1, [0.5] * (dim + 1))]
    full = [(i, v, [None, 3, 4][k % 3], "c", 1) for k, (i, v) in enumerate(rows + bad)]
    return spark.createDataFrame(full, SCHEMA).repartition(3), {(i, tuple(v)): [None, 3, 4][k % 3] for k, (i, v) in enumerate(rows)}


def plain_codes(rows, parts, k, rounds, scale):
    dim = len(rows[0][1])
    width = -(-dim // parts)
    cut = []
    for i, v in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        x = [math.floor(scale * c) for c in v] + [0] * (parts * width - dim)
        cut.append((i, [x[p * width : (p + 1) * width] for p in range(parts)]))
    books = [[c[p] for _, c in cut[:k]] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, c in cut:
                own.setdefault(near(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(col) // len(own[j]) for col in zip(*own[j])] if j in own else e for j, e in enumerate(books[p])]
    out = []
    for i, c in cut:
        got = [near(x, b) for x, b in zip(c, books)]
        out.append((i, "".join(f"{j:02x}" for _, j in got), sum(d for d, _ in got)))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


@pytest.mark.parametrize(("n", "dim", "scale"), [(400, 64, 1), (150, 48, 1), (150, 20, 1), (30, 64, 1), (90, 32, 2.0**40), (70, 16, 2.0**100)])
def test_codes(spark, n, dim, scale):
    rows = [(i, [c * scale for c in v]) for i, v in vectors(n, dim)]
    rows += [rows[0], (5000, rows[1][1]), (None, rows[2][1])]
    df, _ = frame(spark, rows)
    books = codes.train(df)
    got = codes.encode(df, books).collect()
    want, digest = plain_codes(rows, codes.PARTS, codes.ENTRIES, codes.ROUNDS, codes.SCALE)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted([(r.vec_id, r.code, r.error) for r in got], key=key) == sorted([(i, c, e if e < 1 << 63 else None) for i, c, e in want], key=key)
    assert books.digest() == digest


def test_entries_are_eliminated_early(spark):
    df, _ = frame(spark, vectors(2000, 256, 3, clusters=32))
    terms = [r.terms for r in codes.encode(df, codes.train(df)).collect()]
    assert np.mean(terms) < 0.4 * 64 * 256


def test_transform_keeps_distances():
    g = np.random.default_rng(1)
    a, c = g.integers(-9, 9, (50, 5)), g.integers(-9, 9, (20, 5))
    ta, tc = codes.transform(a), codes.transform(c)
    want = ((a[:, None] - c) ** 2).sum(2)
    assert (((ta[:, None] - tc) ** 2).sum(2) == 8 * want).all()
    entry, d, added = codes.nearest(ta, tc)
    assert (d == want.min(1)).all() and (entry == want.argmin(1)).all() and (added <= 20 * 8 + 8).all()
    rows = codes.transform(np.eye(8, dtype=int)).T
    assert [int((r[1:] != r[:-1]).sum()) for r in rows] == list(range(8))


def test_decoded_vectors_are_as_far_as_the_error(spark):
    rows = vectors(300, 64)
    df, _ = frame(spark, rows)
    books = codes.train(df)
    coded = codes.encode(df, books)
    back = {r.vec_id: r.vector for r in codes.decode(coded, books).collect()}
    whole = {i: np.floor(256 * np.array(v)) for i, v in rows}
    assert all(((np.array(back[r.vec_id]) * 256 - whole[r.vec_id]) ** 2).sum() == r.error for r in coded.collect())


def plain_clusters(rows, k, rounds, scale, seed):
    x = [(i, [math.floor(scale * c) for c in v]) for i, v in rows]
    sha = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    c = [v for _, v in sorted(x, key=lambda r: (r[0] is None, sha(r[0]), r[1]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, e)), j) for j, e in enumerate(c))
    for _ in range(rounds):
        own = {}
        for _, v in x:
            own.setdefault(near(v)[1], []).append(v)
        c = [[sum(col) // len(own[j]) for col in zip(*own[j])] if j in own else e for j, e in enumerate(c)]
    return [(i, *near(v)[::-1]) for i, v in x], c


@pytest.mark.parametrize(("n", "clusters", "scale"), [(500, 0, 1), (600, 20, 1), (10, 0, 1), (80, 0, 2.0**40), (60, 5, 2.0**100)])
def test_clusters(spark, n, clusters, scale):
    rows = [(i, [c * scale for c in v]) for i, v in vectors(n, 64, 5, clusters)]
    rows += [rows[0], (5000, rows[1][1]), (None, rows[2][1])]
    df, _ = frame(spark, rows)
    got, c = centroids.cluster(df, _common.Scratch(spark))
    want, centres = plain_clusters(rows, centroids.CLUSTERS, centroids.ROUNDS, centroids.SCALE, centroids.SEED)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    got = got.collect()
    assert sorted([(r.vec_id, r.cluster, r.distance) for r in got], key=key) == sorted([(i, j, d if d < 1 << 63 else None) for i, j, d in want], key=key)
    assert [[int(v) for v in r] for r in c] == centres
    assert not clusters or scale > 1 or np.mean([r.checked for r in got]) < 5


def test_bounds_lie_below_distances():
    g = np.random.default_rng(2)
    x, c, p = (g.integers(-200, 200, (n, 8)) for n in (300, 6, 6))
    p[:3] = c[:3]
    p[5] = 1 << 20
    s = centroids.State(c, p, False).prepare()
    assert (s.bounds(centroids.roots(centroids.distances(x, p))) <= centroids.distances(x, c)).all()


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert codes.train(none) is None
    assert centroids.cluster(none, _common.Scratch(spark))[0].count() == 0
    df, _ = frame(spark, [])
    assert codes.train(df.filter("vec_id >= 9000")) is None


def test_limbs():
    x = np.array([0, 5, -5, 1 << 100, -(1 << 100), -1], object)
    assert [integers.joined(v) for v in zip(*integers.limbs(x, 5))] == x.tolist()
    y = np.array([0, 7, -(1 << 40), (1 << 61) + 3])
    assert [integers.joined(v) for v in zip(*integers.limbs(y, 4))] == y.tolist()
