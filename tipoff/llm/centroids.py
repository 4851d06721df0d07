"""Centroid clustering of integer vectors with Ptolemaic pivots.

Vectors with exactly DIM components become integers floor(SCALE * x). For Euclidean distances d, Ptolemy's inequality bounds the
distance of a vector x to a centroid c from below by any pair of pivots p, s:

    d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s).

The pivots are fixed for the whole run, so a vector's distances to them are computed once and stored beside it in a written table;
in each round the driver only computes those of the centroids. Of all pivot pairs, a vector and a centroid use those of the centroid's nearest
pivot with the vector's NEAR nearest ones and with a far point, where the bound is tightest (with s far away the bound nears
d(x, p) - d(c, p); any points may be pivots, not only data). Bounds are lowered by more than their rounding error (each
stored distance is off by less than two units of its last place, so a product difference by less than seven of the sum of products; SLACK
allows 16), and centroids are visited by their bounds: one whose bound lies beyond the best exact squared distance ends the search, the
others are checked in whole numbers. So pivots decide only how much is computed, never what.

Pivots are the centroids that plain rounds on a bounded sample give (at most SAMPLE vectors of the smallest hashes): later centroids stay
near them, which makes bounds tight. Every vector is clustered.

Each round is one scan of the written table; a task adds up its vectors by cluster and sends one row for each cluster.

Defined results: rows take part if their vector has DIM components, none null or non-finite (nor of 2**1000 or more). Repeated rows
and vec_ids are clustered each; rows without vec_id start no centroid before those that have one; start ties go to the smaller vector. With fewer
vectors than CLUSTERS there are as many centroids as vectors; an empty table gives an empty result. A distance or sum that doesn't fit a
long is null. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm import _common, integers

CLUSTERS, ROUNDS, DIM, SCALE, SEED = 16, 3, 64, 64, 1
SAMPLE, NEAR, FAR = 1 << 14, 2, 1 << 12
UNIT = 2.0**-53
SLACK = 16 * UNIT


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to rows."""
    return np.stack([((x - row) ** 2).sum(1) for row in c], 1) if len(c) else np.zeros((len(x), 0), x.dtype)


def roots(d: np.ndarray) -> np.ndarray:
    """Square roots as doubles; infinite where a squared distance is beyond them (bounds from it rule nothing out)."""
    if d.dtype == object:
        d = np.array([float(v) if v < 1 << 1020 else np.inf for v in d.ravel()]).reshape(d.shape)
    return np.sqrt(d.astype(float))


@dataclass
class State:
    """Centroids, fixed pivots and their distances to each other."""

    centroids: np.ndarray
    pivots: np.ndarray
    big: bool

    def prepare(self) -> State:
        self.to_pivot = roots(distances(self.centroids, self.pivots))  # centroid x pivot
        self.between = roots(distances(self.pivots, self.pivots))
        self.own = self.to_pivot[:, :-1].argmin(1)  # each centroid's nearest pivot but the far one, which comes last
        return self

    def bounds(self, dp: np.ndarray) -> np.ndarray:
        """Squared lower bounds on the distances of vectors (from their pivot distances) to all centroids, below the true ones."""
        best = np.zeros((len(dp), len(self.centroids)))
        with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
            far = np.full((1, len(dp)), dp.shape[1] - 1)
            for s in (*np.argsort(dp[:, :-1], axis=1, kind="stable")[:, :NEAR].T, *far):
                to_s = dp[np.arange(len(dp)), s]
                a, b = dp[:, self.own] * self.to_pivot[:, s].T, to_s[:, None] * self.to_pivot[np.arange(len(self.own)), self.own]
                low = (np.abs(a - b) - SLACK * (a + b)) / self.between[self.own[None, :], s[:, None]] * (1 - SLACK)
                best = np.fmax(best, np.where(np.isfinite(low), low, 0))
        return best * best * (1 - SLACK)

    def assign(self, x: np.ndarray, dp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest centroid (ties: the smaller number), exact squared distance and the number of exact distances of each vector."""
        low = self.bounds(dp)
        order = np.argsort(low, axis=1, kind="stable")
        best = ((x - self.centroids[order[:, 0]]) ** 2).sum(1)
        at, checked = order[:, 0].copy(), np.ones(len(x), np.int64)
        limit = roots(best) ** 2 * (1 + SLACK)
        live = np.arange(len(x))
        for j in range(1, order.shape[1]):
            c = order[live, j]
            stay = ~(low[live, c] > limit[live])
            live, c = live[stay], c[stay]
            if not len(live):
                break
            d = ((x[live] - self.centroids[c]) ** 2).sum(1)
            checked[live] += 1
            nearer = ((d < best[live]) | ((d == best[live]) & (c < at[live]))).astype(bool)
            won = live[nearer]
            best[won], at[won] = d[nearer], c[nearer]
            limit[won] = roots(best[won]) ** 2 * (1 + SLACK)
        return at, best, checked


def moved(centroids: np.ndarray, n: list[int], sums: list[list[int]]) -> np.ndarray:
    """The floor of each non-empty cluster's mean; empty ones stay."""
    out = centroids.copy()
    for k, (m, s) in enumerate(zip(n, sums, strict=True)):
        if m:
            out[k] = [int(v) // m for v in s]
    return out


def pivots_of(sample: np.ndarray, start: np.ndarray, rounds: int) -> np.ndarray:
    """Centroids of plain rounds on a sample, without repeats, and a point FAR times as far away as any component reaches."""
    c = start
    for _ in range(rounds if len(sample) else 0):
        at = distances(sample, c).argmin(1)
        n = np.bincount(at, minlength=len(c)).tolist()
        c = moved(c, n, integers.add_by(at, sample, len(c)).tolist())
    c = np.array(sorted({tuple(r) for r in c.tolist()}), c.dtype).reshape(-1, start.shape[1])
    return np.r_[c, np.full((1, c.shape[1]), FAR * (1 + max(abs(c.max()), abs(c.min()))), c.dtype)]


@_common.tidy
def _cached(batches: Iterator[pa.RecordBatch], state: State, dim: int, scale: int) -> Iterator[pa.RecordBatch]:
    """Floored vectors (whole numbers as doubles) and their distances to the pivots."""
    for b in batches:
        x = integers.floors(integers.matrix(b.column("v"), dim), scale, state.big)
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(list(x.astype(float)), pa.list_(pa.float64())), pa.array(list(roots(distances(x, state.pivots))), pa.list_(pa.float64()))], names=["vec_id", "x", "dp"])


def _read(b: pa.RecordBatch, state: State) -> tuple[np.ndarray, np.ndarray]:
    x = integers.floors(integers.matrix(b.column("x"), state.centroids.shape[1]), 1, state.big)
    return x, integers.matrix(b.column("dp"), len(state.pivots))


@_common.tidy
def _sums(batches: Iterator[pa.RecordBatch], state: State, limbs: int) -> Iterator[pa.RecordBatch]:
    """Number and sum of each cluster's vectors in a task."""
    k, dim = state.centroids.shape
    n, sums = np.zeros(k, np.int64), np.zeros((k, dim), state.centroids.dtype)
    for b in batches:
        x, dp = _read(b, state)
        at, _, _ = state.assign(x, dp)
        n += np.bincount(at, minlength=k)
        sums = sums + integers.add_by(at, x, k)
    used = np.flatnonzero(n)
    parts = [integers.limbs(sums[used, c], limbs) for c in range(dim)]
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used]), *(pa.array(z) for p in parts for z in p)], names=["cluster", "n", *(f"s{i}" for i in range(dim * limbs))])


@_common.tidy
def _assigned(batches: Iterator[pa.RecordBatch], state: State) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at, d, checked = state.assign(*_read(b, state))
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(at.astype(np.int32)), integers.longs(d), pa.array(checked)], names=["vec_id", "cluster", "distance", "checked"])


def cluster(vecs: DataFrame, scratch: _common.Scratch, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance and checked (exact distances that were computed) of each vector, and the final centroids."""
    spark = vecs.sparkSession
    _common.ship(spark)
    rows = integers.usable(vecs).filter(F.size("v") == dim)
    found = integers.lengths(rows)
    if not found:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, checked long"), np.zeros((0, dim), np.int64)
    big, limbs = integers.wide(found[0].top * (FAR + 1), scale, dim), integers.n_limbs(found[0].top, scale)
    floored = lambda got: integers.floors(np.array([r.v for r in got], float).reshape(-1, dim), scale, big)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    start = floored(rows.orderBy(key.asc_nulls_last(), "v").limit(clusters).collect())
    sample = floored(_common.bounded(rows, SAMPLE, "vec_id", "v").collect())
    state = State(start, pivots_of(sample, start, rounds), big).prepare()
    stored = scratch.keep(rows.mapInArrow(lambda it, s=state: _cached(it, s, dim, scale), "vec_id long, x array<double>, dp array<double>"), "vectors")
    names = [f"s{i}" for i in range(dim * limbs)]
    for _ in range(rounds):
        sums = stored.mapInArrow(lambda it, s=state: _sums(it, s, limbs), "cluster int, n long, " + ", ".join(f"{c} long" for c in names))
        n, total = [0] * len(start), [[0] * dim for _ in start]
        for r in sums.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in names)).collect():  # a row for each cluster
            n[r.cluster], total[r.cluster] = r.n, [integers.joined(r[2 + c * limbs : 2 + (c + 1) * limbs]) for c in range(dim)]
        state = replace(state, centroids=moved(state.centroids, n, total)).prepare()
    out = scratch.keep(stored.mapInArrow(lambda it, s=state: _assigned(it, s), "vec_id long, cluster int, distance long, checked long"), "assigned")
    scratch.drop(stored)
    return out, state.centroids


def op12_ptolemaic_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns; the clusters' sums and digests (a row for each of 16) go to every task."""
    found, centroids = cluster(_common.table(spark, sf_dir, "embeddings"), _common.Scratch(spark))
    sums = {r.cluster: r.s for r in found.groupBy("cluster").agg(integers.total("distance").alias("s")).collect()}
    inertia = None if any(s is None for s in sums.values()) else integers.as_long(sum(sums.values()))
    digest = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centroids]
    rows = [(k, integers.as_long(s), inertia, digest[k]) for k, s in sums.items()]
    by_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(by_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    steps = [
        f"k AS MATERIALIZED (SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) AS rank, embedding AS v FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"x AS MATERIALIZED (SELECT vec_id, rank, i AS pos, CAST(floor({SCALE} * CAST(v[i] AS DOUBLE)) AS BIGINT) AS c FROM k, unnest(range(1, len(v) + 1)) AS u(i))",
        f"c0 AS MATERIALIZED (SELECT rank - 1 AS cluster, pos, c FROM x WHERE rank <= {CLUSTERS})",
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, cluster, d FROM (SELECT x.vec_id, b.cluster, sum((x.c - b.c) * (x.c - b.c)) AS d FROM x JOIN c{r} AS b ON x.pos = b.pos GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1)")
        if r < ROUNDS:
            steps.append(f"m{r} AS (SELECT cluster, pos, sum(c) AS s, count(*) AS n FROM x JOIN a{r} USING (vec_id) GROUP BY ALL)")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT cluster, pos, CAST(coalesce((s - ((s % n) + n) % n) // n, c) AS BIGINT) AS c FROM c{r} LEFT JOIN m{r} USING (cluster, pos))")
    steps.append(f"h AS (SELECT cluster, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY pos)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY cluster)")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN h USING (cluster)"""


QUERIES = {"op12_ptolemaic_clusters": op12_ptolemaic_clusters}
ORACLE: dict[str, str] = {"op12_ptolemaic_clusters": _sql()}
