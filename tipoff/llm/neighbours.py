"""Approximate nearest neighbours by projections, a kd-tree and a chi-square stopping test.

Vectors are extended by one coordinate so that the largest inner product is the smallest Euclidean distance, and projected to
DIMS Gaussian (2-stable) coordinates. One kd-tree indexes them all: its upper levels cut the projections into cells that are
spread over the cluster (their cuts are medians of a bounded sample, every row is indexed), its lower levels are built inside
a cell. A query takes projected neighbours in increasing order, a leaf at a time. Of a leaf, it verifies on the original vectors only
those whose projected distance the chi-square test leaves open, and stops when the test rules out all that are left: when a nearer
vector than its current k-th would by now have shown up with probability CONFIDENCE. For a true squared distance d2 the projected
squared distance is d2 times a chi-square variable of DIMS degrees of freedom, so a true neighbour is passed over with probability
1 - CONFIDENCE at most. So a query goes to the nearest cell first, then only to those cells whose box the test does not rule out at the k-th
distance found so far; queries travel to cells, not vectors to queries.

Bounded sample: the upper cuts are fitted on at most SAMPLE rows, chosen by a hash of vec_id. A cell of more than CELL rows (a
vector that a third of all rows repeat) is dealt into parts by a hash, a cell that more than ASKS queries come to is copied
for each further ASKS of them: no task gathers more than CELL vectors and ASKS queries.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part; with fewer than k candidates all are returned; ties go to the smaller vec_id; repeated vec_ids keep one vector (the
first in order); an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tipoff.llm import _common, _text

DIMS, CONFIDENCE, LEAF, SEED = 16, 0.92, 64, 8
CELL, ASKS, SAMPLE, TOP, QUERY_STEP = 8192, 4096, 1 << 17, 20, 20
#: Nearest cells that a query has been to after each round, and queries searched together.
ROUNDS, TOGETHER = (1, 9, 1 << 30), 256
FOUND = "query_id long, vec_id long, score double"


def chi_square_cdf(x: np.ndarray, dof: int) -> np.ndarray:
    """For an even number of degrees of freedom."""
    h = np.minimum(np.asarray(x, float) / 2, 700.0)
    term, total = np.ones_like(h), np.ones_like(h)
    for k in range(1, dof // 2):
        term = term * h / k
        total = total + term
    return 1 - np.exp(-h) * total


def quantile(p: float, dof: int) -> float:
    """Where the chi-square distribution reaches p."""
    low, high = 0.0, 10.0 * dof + 100
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(np.array(mid), dof) < p else (low, mid)
    return high


#: A projected squared distance beyond this many times the k-th squared distance rules a vector, leaf or cell out.
BEYOND = quantile(CONFIDENCE, DIMS)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Space:
    """The projection, the kd-tree's upper cuts and the boxes of its cells."""

    def __init__(self, dim: int, bound: float) -> None:
        self.dim, self.bound = dim, bound
        self.proj = np.random.default_rng(SEED).standard_normal((dim + 1, DIMS))
        self.depth, self.axis, self.cut = 0, np.zeros(0, np.int64), np.zeros(0)
        self.low = self.high = np.zeros((0, DIMS))
        self.parts = np.zeros(0, np.int64)

    def points(self, x: np.ndarray) -> np.ndarray:
        """Projections of data, extended to the largest norm."""
        return np.c_[x, np.sqrt(np.maximum(self.bound - (x * x).sum(1), 0))] @ self.proj

    def queries(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Projections of queries at the largest norm (scaling a query keeps its ranking), and the scales."""
        scale = np.sqrt(self.bound / (v * v).sum(1))
        return (v * scale[:, None]) @ self.proj[: self.dim], scale

    def fit(self, sample: np.ndarray, cells: int) -> None:
        """Cuts at medians of the widest coordinate, level by level, to at least `cells` cells."""
        self.depth = max(0, cells - 1).bit_length()
        self.axis, self.cut = np.zeros((1 << self.depth) - 1, np.int64), np.full((1 << self.depth) - 1, np.inf)
        node = np.zeros(len(sample), np.int64)
        for level in range(self.depth):
            for t in range((1 << level) - 1, (2 << level) - 1):
                part = sample[node == t]
                if len(part):
                    self.axis[t] = np.argmax(np.ptp(part, axis=0))
                    self.cut[t] = np.median(part[:, self.axis[t]])
            node = self.below(node, sample)

    def below(self, node: np.ndarray, x: np.ndarray) -> np.ndarray:
        return 2 * node + 1 + (x[np.arange(len(x)), self.axis[node]] > self.cut[node])

    def cell(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            node = self.below(node, x)
        return node - ((1 << self.depth) - 1)


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each query to each box."""
    d = np.zeros((len(q), len(low)))
    for k in range(q.shape[1]):
        x = q[:, k, None]
        gap = np.maximum(low[:, k] - x, 0) + np.maximum(x - high[:, k], 0)
        d += gap * gap
    return d


class KdTree:
    """Leaves of at most LEAF points with their bounding boxes, split at medians of the widest coordinate."""

    def __init__(self, points: np.ndarray) -> None:
        leaves, stack = [], [np.arange(len(points))]
        while stack:
            at = stack.pop()
            if len(at) <= LEAF:
                leaves.append(at)
                continue
            d = int(np.argmax(np.ptp(points[at], axis=0)))
            order = at[np.argsort(points[at, d], kind="stable")]
            stack += [order[: len(at) // 2], order[len(at) // 2 :]]
        self.leaves, self.points = leaves, points
        self.size = (points * points).sum(1)
        self.low = np.stack([points[x].min(0) for x in leaves])
        self.high = np.stack([points[x].max(0) for x in leaves])

    def order(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query, leaves by distance of their box, and those squared distances."""
        d = box_distance(q, self.low, self.high)
        o = np.argsort(d, axis=1, kind="stable")
        return o, np.take_along_axis(d, o, 1)


def usable(vecs: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    v = _common.columns(vecs, vec_id="long", embedding="array<double>")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.filter("vec_id is not null and embedding is not null").filter(~bad).filter(F.exists("embedding", lambda x: x != 0))
    return v.groupBy("vec_id").agg(F.min("embedding").alias("v"))


def search(x: np.ndarray, ids: np.ndarray, v: np.ndarray, qids: np.ndarray, least: np.ndarray, space: Space, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Queries, data rows and scores: the k best of one cell part for each query, none below the k-th score that it has already (least); and the vectors verified for each query.

    ids ascend.
    """
    tree = KdTree(space.points(x))
    out = []
    for a in range(0, len(v), TOGETHER):
        out.append(_some(tree, x, ids, v[a : a + TOGETHER], qids[a : a + TOGETHER], least[a : a + TOGETHER], space, k))
        out[-1] = (out[-1][0] + a, *out[-1][1:])
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def products(v: np.ndarray, x: np.ndarray, ask: np.ndarray) -> np.ndarray:
    """Inner products of the pairs that are asked for, -inf elsewhere."""
    if ask.mean() > 0.25:  # a whole product costs less than gathering its pairs
        return np.where(ask, v @ x.T, -np.inf)
    out = np.full(ask.shape, -np.inf)
    i, j = np.nonzero(ask)
    out[i, j] = (v[i] * x[j]).sum(1)
    return out


def _some(tree: KdTree, x: np.ndarray, ids: np.ndarray, v: np.ndarray, qids: np.ndarray, least: np.ndarray, space: Space, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    # at the data's largest norm, distances and inner products agree best
    p, scale = space.queries(v)
    order, far = tree.order(p)
    size, verified = (p * p).sum(1), np.zeros(len(v), np.int64)
    limit = BEYOND * np.maximum(2 * space.bound - 2 * scale * least, 1e-12)
    best_s, best_at = np.full((len(v), k), -np.inf), np.full((len(v), k), -1)
    live, at, step = np.arange(len(v)), 0, 4
    while len(live) and at < order.shape[1]:
        want = order[live, at : at + step]
        s, rows = np.full((len(live), want.shape[1], LEAF), -np.inf), np.full((len(live), want.shape[1], LEAF), -1)
        by_leaf = np.argsort(want, axis=None, kind="stable")
        lim = np.searchsorted(want.ravel()[by_leaf], np.arange(len(tree.leaves) + 1))
        for t, leaf in enumerate(tree.leaves):  # the queries that come to a leaf in this round, together
            who, slot = np.divmod(by_leaf[lim[t] : lim[t + 1]], want.shape[1])
            if len(who):
                q = live[who]
                ask = size[q][:, None] + tree.size[leaf] - 2 * (p[q] @ tree.points[leaf].T) <= limit[q][:, None]
                verified += np.bincount(q, ask.sum(1), len(v)).astype(np.int64)
                s[who, slot, : len(leaf)] = products(v[q], x[leaf], ask)
                rows[who, slot, : len(leaf)] = np.where(ask, leaf, -1)
        s, rows = np.c_[best_s[live], s.reshape(len(live), -1)], np.c_[best_at[live], rows.reshape(len(live), -1)]
        s[(rows >= 0) & (ids[rows] == qids[live][:, None])] = -np.inf
        top = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(live), -np.inf)
        # near-ties are settled on inner products that are summed alike, then by id
        who, col = np.nonzero((s >= np.maximum(top, least[live])[:, None] - 1e-9) & (s > -np.inf))
        cand = rows[who, col]
        exact = (x[cand] * v[live[who]]).sum(1)
        o = np.lexsort((ids[cand], -exact, who))
        who, cand, exact = who[o], cand[o], exact[o]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        o = rank < k
        best_s[live], best_at[live] = -np.inf, -1
        best_s[live[who[o]], rank[o]], best_at[live[who[o]], rank[o]] = exact[o], cand[o]
        at, step = at + step, min(step * 2, 32)
        limit[live] = BEYOND * np.maximum(2 * space.bound - 2 * scale[live] * np.maximum(best_s[live, k - 1], least[live]), 1e-12)
        if at < order.shape[1]:
            live = live[far[live, at] <= limit[live]]
    who, rank = np.nonzero(best_at >= 0)
    return who, best_at[who, rank], best_s[who, rank], verified


@_common.tidied
def _meet(key: tuple, q: pa.Table, d: pa.Table, space: Space, k: int) -> pa.Table:
    if not q.num_rows or not d.num_rows:
        who = row = np.zeros(0, np.int64)
        ids, qids, score = who, who, np.zeros(0)
    else:
        q, d = q.combine_chunks(), d.combine_chunks()
        ids, qids = d.column("vec_id").to_numpy(), q.column("vec_id").to_numpy()
        o = np.argsort(ids, kind="stable")
        x, v = (matrix(t.column("v").chunk(0), space.dim) for t in (d, q))
        ids, x = ids[o], x[o]
        who, row, score, _ = search(x, ids, v, qids, q.column("least").to_numpy(), space, k)
    return pa.table({"query_id": pa.array(qids[who], pa.int64()), "vec_id": pa.array(ids[row], pa.int64()), "score": pa.array(score, pa.float64())})


@_common.tidy
def _points(batches: Iterator[pa.RecordBatch], space: Space) -> Iterator[pa.RecordBatch]:
    for b in batches:
        p = space.points(matrix(b.column("v"), space.dim))
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(list(p), pa.list_(pa.float64()))], names=["vec_id", "p"])


@_common.tidy
def _boxes(batches: Iterator[pa.RecordBatch], space: Space) -> Iterator[pa.RecordBatch]:
    """Rows, lowest and highest coordinates of each cell in a batch."""
    for b in batches:
        p = space.points(matrix(b.column("v"), space.dim))
        c = space.cell(p)
        cells, n = np.unique(c, return_counts=True)
        low, high = (np.array([f(p[c == x], axis=0) for x in cells]).reshape(-1, DIMS) for f in (np.min, np.max))
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(n), *(pa.array(z[:, i]) for z in (low, high) for i in range(DIMS))], names=["cell", "n", *(f"{z}{i}" for z in "lh" for i in range(DIMS))])


@_common.tidy
def _place(batches: Iterator[pa.RecordBatch], space: Space, copies: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The vectors by cell, part and the block of queries that they meet; cells that no query comes to are left out."""
    for b in batches:
        ids = b.column("vec_id").to_numpy()
        c = space.cell(space.points(matrix(b.column("v"), space.dim)))
        n = copies[c]
        row = np.repeat(np.arange(len(c)), n)
        block = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        part = _text.mix(ids.view(np.uint64)) % space.parts[c].astype(np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(c[row]), pa.array(part[row].astype(np.int64)), pa.array(block), b.column("vec_id").take(pa.array(row)), b.column("v").take(pa.array(row))], names=["cell", "part", "block", "vec_id", "v"])


@_common.tidy
def _route(batches: Iterator[pa.RecordBatch], space: Space, first: int, last: int) -> Iterator[pa.RecordBatch]:
    """The cells that each query still has to go to among its first to last - 1 nearest: those that the chi-square test leaves open."""
    for b in batches:
        for a in range(0, b.num_rows, TOGETHER):
            some = b.slice(a, TOGETHER)
            p, scale = space.queries(matrix(some.column("v"), space.dim))
            least = some.column("least").to_numpy(zero_copy_only=False)
            d = box_distance(p, space.low, space.high)
            o = np.argsort(d, axis=1, kind="stable")[:, first:last]
            kth = np.maximum(2 * space.bound - 2 * scale * least, 1e-12)
            row, col = np.nonzero(np.take_along_axis(d, o, 1) <= BEYOND * kth[:, None])
            yield pa.RecordBatch.from_arrays([some.column(c).take(pa.array(row)) for c in ("vec_id", "v", "least")] + [pa.array(o[row, col])], names=["vec_id", "v", "least", "cell"])


def nearest(vecs: DataFrame, queries: DataFrame, k: int = TOP, data_block: int = CELL, query_block: int = ASKS) -> DataFrame:
    """query_id, rank, vec_id, score: the k vectors of largest inner product found for each query.

    No task gathers more than data_block vectors, nor (on average over hash blocks) more than query_block queries.
    """
    cell = data_block
    spark = vecs.sparkSession
    _common.ship(spark)
    scratch = _common.Scratch(spark)
    v, q = scratch.keep(usable(vecs), "vectors"), usable(queries)
    dims = v.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = dims[0].dim
    v, q = v.filter(F.size("v") == dim), scratch.keep(q.filter(F.size("v") == dim), "queries")
    n, bound = v.agg(F.count(F.lit(1)), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).collect()[0]
    space = Space(dim, float(bound))
    if n > cell:
        sample = _common.bounded(v.mapInArrow(lambda it: _points(it, space), "vec_id long, p array<double>"), SAMPLE, "vec_id").toPandas()
        space.fit(np.stack(sample.p.to_list()), min(-(-n // cell), SAMPLE // 16))
    sides = [f"{z}{i}" for z in "lh" for i in range(DIMS)]
    boxes = v.mapInArrow(lambda it: _boxes(it, space), "cell long, n long, " + ", ".join(f"{c} double" for c in sides))
    boxes = boxes.groupBy("cell").agg(F.sum("n").alias("n"), *((F.min if c[0] == "l" else F.max)(c).alias(c) for c in sides)).toPandas()  # at most SAMPLE / 16 rows, or n / cell
    space.low, space.high = np.full((1 << space.depth, DIMS), np.inf), np.full((1 << space.depth, DIMS), -np.inf)
    space.parts = np.ones(1 << space.depth, np.int64)
    at = boxes.cell.to_numpy(np.int64)
    space.low[at], space.high[at] = boxes[sides[:DIMS]].to_numpy(float), boxes[sides[DIMS:]].to_numpy(float)
    space.parts[at] = -(-boxes.n.to_numpy(np.int64) // cell)
    found, first = None, 0
    of_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    for last in ROUNDS:
        if first >= 1 << space.depth:
            break
        have = q.withColumn("least", F.lit(float("-inf")))
        if found is not None:
            kth = found.withColumn("rank", F.row_number().over(of_query)).filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
            have = q.join(kth, "vec_id", "left").select("vec_id", "v", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
        asks = scratch.keep(have.mapInArrow(lambda it, a=first, b=last: _route(it, space, a, b), "vec_id long, v array<double>, least double, cell long"), "asks")
        first = last
        copies = np.zeros(1 << space.depth, np.int64)
        for r in asks.groupBy("cell").count().collect():  # a row for each cell
            copies[r.cell] = -(-r["count"] // query_block)
        if not copies.any():
            break
        parts, blocks = (spark.createDataFrame([(i, int(x)) for i, x in enumerate(z)], f"cell long, {name} long") for name, z in (("parts", space.parts), ("blocks", copies)))
        left = asks.join(F.broadcast(parts), "cell").join(F.broadcast(blocks), "cell")  # a row for each cell
        left = left.select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("vec_id"), "blocks").alias("block"), "vec_id", "v", "least")
        right = v.mapInArrow(lambda it, c=copies: _place(it, space, c), "cell long, part long, block long, vec_id long, v array<double>")
        key = ["cell", "part", "block"]
        got = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(lambda x, a, b: _meet(x, a, b, space, k), FOUND)
        got = scratch.keep(got, "found")
        # the k best so far go on
        found = (got if found is None else found.unionByName(got)).withColumn("rank", F.row_number().over(of_query)).filter(F.col("rank") <= k).drop("rank")
        scratch.drop(asks)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return found.withColumn("rank", F.row_number().over(of_query)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vecs = _common.table(spark, sf_dir, "embeddings")
    return nearest(vecs, vecs.filter(F.col("vec_id") % QUERY_STEP == 0))


QUERIES = {"op8_nearest_neighbours": op8_nearest_neighbours}
ORACLE: dict[str, str] = {}
