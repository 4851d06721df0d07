"""Toxicity by maximum-scoring segments.

Token log-odds with a Dirichlet prior come from a bounded sample of labelled training rows. Every other text is scanned
in linear time for all its maximal scoring segments (toxic passages). Segment scores S of a text of n tokens are calibrated by
the extreme-value law P(S >= x) = 1 - exp(-K n exp(-lambda x)), whose lambda and K are fitted by maximum likelihood to the best
segments of background rows; several passages are judged together by the law of the sum of the r best. A logistic curve
fitted on the training rows turns that evidence into a probability.

Bounded sample: at most MAX_TRAIN labelled doc_ids, chosen by a hash, with one text each. Features of a token are its folded
word and the word's leading 4 to 8 bytes; the most significant one scores it.

Defined results: null or empty texts have no segment and get the score of no evidence; without usable labels (none, or
of one kind) every score is the share of toxic labels (0 if none); a doc_id with several labels counts as toxic if any
says so, and one with several texts is learned from the smallest; repeated rows give repeated results; texts of any length
are scanned whole; equal segments keep the order of the text; an empty table gives an empty result; extra columns are ignored. Tokens are runs of letters A-Z,
a-z (folded) and of bytes beyond ASCII.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm import _common, _text

MAX_TRAIN = 20_000
PREFIXES = (4, 5, 6, 7, 8)
#: Prior mass, least significance and log-odds of a feature, bound of a token's log-odds, what a token without evidence costs.
PRIOR, MIN_Z, MIN_ODDS, CLIP, DRIFT = 4.0, 3.3, 1.5, 8.0, 0.25
#: The least calibrated score of a significant passage (E-value 0.05).
MIN_BITS = 3.0
THRESHOLD = 0.3

LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
TABLE, BASE = _text.byte_table(6, fold_case=True), 0x9E3779B97F4A7C55 | 1


def features(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and distinct-word number of each token, and the features (columns) of each distinct word; 0 marks none."""
    s, e, row = _text.word_bounds(data, offs, LETTERS)
    h = _text.word_hashes(data, s, e, TABLE, BASE)
    _, at, word = np.unique(h, return_index=True, return_inverse=True)
    cols = [h[at]]
    for n in PREFIXES:
        f = np.zeros(len(at), np.uint64)
        long = np.flatnonzero(e[at] - s[at] > n)
        f[long] = _text.mix(_text.word_hashes(data, s[at][long], s[at][long] + n, TABLE, BASE), n)
        cols.append(f)
    return row, word, np.stack(cols, 1)


@_common.tidy
def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct features of each training row, summed by label within the batch."""
    for batch in batches:
        y = np.asarray(batch.column("toxic").to_pylist(), np.int64)
        keys, counts = [], []
        for i, j, data, offs in _text.slices(batch, "text"):
            row, word, f = features(data, offs)
            rows, keys_of = np.repeat(row, f.shape[1]), f[word].ravel() if len(row) else np.zeros(0, np.uint64)
            real = keys_of != 0
            rows, keys_of = rows[real], keys_of[real]
            once = np.unique(_text.mix(keys_of ^ _text.mix(rows.astype(np.uint64), 1)), return_index=True)[1]  # once for each row
            rows = rows[once]
            k, inv = np.unique(keys_of[once], return_inverse=True)
            toxic = np.bincount(inv, y[i:j][rows], len(k)) if len(k) else np.zeros(0)
            keys.append(k)
            counts.append(np.stack([toxic, np.bincount(inv, minlength=len(k)) - toxic], 1) if len(k) else np.zeros((0, 2)))
        c = np.concatenate(counts) if counts else np.zeros((0, 2))
        k = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c[:, 0]), pa.array(c[:, 1])], names=["f", "y1", "y0"])


def maximal_segments(pos: np.ndarray, score: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, last token, score) of a row whose tokens cost drift except those at pos.

    Linear: each candidate on the stack knows the nearest earlier one that starts from a smaller total, so a search from the top of
    the stack passes over all candidates between the two at once.
    """
    stack: list[tuple[int, int, float, float, int]] = []  # first, last, total before it, total after it, link
    total, at = 0.0, 0
    for p, x in zip(pos.tolist(), score.tolist(), strict=True):
        total -= drift * (p - at)
        at = p + 1
        left, total = total, total + x
        if x <= 0:
            continue
        first, k = p, len(stack) - 1
        while True:
            while k >= 0 and stack[k][2] >= left:
                k = stack[k][4]
            if k < 0 or stack[k][3] >= total:
                stack.append((first, p, left, total, k))
                break
            first, _, left, _, link = stack[k]
            del stack[k:]
            k = link
    return [(a, b, r - l) for a, b, l, r, _ in stack]


class Model:
    """Feature scores, the calibration of segment scores, and the logistic curve."""

    def __init__(self, keys: np.ndarray, odds: np.ndarray, z: np.ndarray, base: float) -> None:
        o = np.argsort(keys)
        self.keys, self.odds, self.z = keys[o], odds[o], z[o]
        self.base, self.lam, self.k, self.a, self.b = base, 1.0, 0.1, 0.0, 0.0

    def word_scores(self, f: np.ndarray) -> np.ndarray:
        """Log-odds of each distinct word by its most significant feature, 0 without one."""
        if len(self.keys) == 0 or len(f) == 0:
            return np.zeros(len(f))
        at = np.minimum(np.searchsorted(self.keys, f), len(self.keys) - 1)
        hit = self.keys[at] == f
        best = np.argmax(np.where(hit, np.abs(self.z[at]), -1.0), 1)
        r = np.arange(len(f))
        return np.where(hit[r, best], self.odds[at[r, best]], 0.0)

    def calibrate(self, best: np.ndarray, tokens: np.ndarray) -> None:
        """lambda and K of the extreme-value law, by maximum likelihood on the best segment scores of background rows (0: none)."""
        hit, n = best > 0, np.maximum(tokens, 1).astype(float)
        m, own, rest = best[hit], n[hit], n[~hit].sum()
        if len(m) < 2 or m.min() == m.max():
            return
        k_of = lambda lam: len(m) / ((own * np.exp(-lam * m)).sum() + rest)
        lo, hi = 1e-3, 20.0
        for _ in range(60):
            lam = (lo + hi) / 2
            slope = len(m) / lam - m.sum() + k_of(lam) * (own * m * np.exp(-lam * m)).sum()
            lo, hi = (lam, hi) if slope > 0 else (lo, lam)
        self.lam, self.k = lo, float(k_of(lo))

    def evidence(self, segments: list[tuple[int, int, float]], tokens: int) -> float:
        """-ln P of the best segment or, where smaller, of the sum of the r best (each more halves the prior), on a scale that is
        logarithmic for large evidence."""
        if not segments:
            return 0.0
        floor = math.log(self.k * max(tokens, 1))
        x = sorted((self.lam * s - floor for _, _, s in segments), reverse=True)
        p = -math.expm1(-math.exp(-x[0])) if x[0] < 30 else None  # beyond, -ln P is x
        most, t = x[0] if p is None else -math.log(p) if p < 1 else 0.0, x[0]
        for r, v in enumerate(x[1:], 2):
            if v <= 0:
                break
            t += v
            if t > r:
                most = max(most, t - (r - 1) * math.log(t) + math.lgamma(r + 1) + math.lgamma(r) - (r - 1) * math.log(2))
        return math.asinh(most / 2)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * x + self.b, -30, 30))) if self.a else np.full(len(x), self.base)

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        """Logistic curve by Newton's method, with a weak ridge and smoothed targets."""
        if len(x) == 0 or y.min() == y.max():
            return
        n1, n0 = y.sum(), len(y) - y.sum()
        t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        m, d = x.mean(), x.std() + 1e-9
        v, w = (x - m) / d, np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(w[0] * v + w[1], -30, 30)))
            g = np.array([((p - t) * v).sum() + 1e-2 * w[0], (p - t).sum()])
            q = p * (1 - p) + 1e-9
            h = np.array([[(q * v * v).sum() + 1e-2, (q * v).sum()], [(q * v).sum(), q.sum() + 1e-9]])
            step = np.linalg.solve(h, g)
            w -= np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        self.a, self.b = float(w[0] / d), float(w[1] - w[0] * m / d)


def passages(batch: pa.RecordBatch, model: Model) -> Iterator[tuple[int, int, list[tuple[int, int, float]]]]:
    """(row, tokens, maximal segments) of each row."""
    for i, j, data, offs in _text.slices(batch, "text"):
        row, word, f = features(data, offs)
        score = model.word_scores(f)[word] if len(row) else np.zeros(0)
        lim = _text.row_slices(row, j - i)
        live = np.flatnonzero(score)
        at = np.searchsorted(live, lim)
        for r in range(j - i):
            p = live[at[r] : at[r + 1]]
            yield i + r, int(lim[r + 1] - lim[r]), maximal_segments(p - lim[r], score[p], DRIFT) if len(p) and (score[p] > 0).any() else []


@_common.tidy
def _evidence(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = np.zeros(b.num_rows)
        found = [[]] * b.num_rows
        for r, n, segs in passages(b, model):
            x[r] = model.evidence(segs, n)
            found[r] = [s for s in segs if model.lam * s[2] - math.log(model.k * n) > MIN_BITS]
        starts = pa.array([[s[0] for s in f] for f in found], pa.list_(pa.int32()))
        ends = pa.array([[s[1] + 1 for s in f] for f in found], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(x), pa.array(model.score(x)), starts, ends], names=["doc_id", "evidence", "score", "starts", "ends"])


@_common.tidy
def _background(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Best segment score and number of tokens of rows labelled 0."""
    for b in batches:
        y = b.column("toxic").to_pylist()
        got = [(max((s for _, _, s in segs), default=0.0), n) for r, n, segs in passages(b, model) if y[r] == 0]
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in got], pa.float64()), pa.array([n for _, n in got], pa.int64())], names=["s", "n"])


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Learn from at most max_train labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    _common.ship(spark)
    labels = _common.columns(labels, doc_id="long", toxic="int").filter("doc_id is not null and toxic in (0, 1)").filter(~_common.held_out())
    ids = _common.bounded(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), max_train, "doc_id")
    ids = spark.createDataFrame([tuple(r) for r in ids.collect()], "doc_id long, toxic int")  # at most max_train rows
    scratch = _common.Scratch(spark)
    rows = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = scratch.keep(rows.select("text", "toxic"), "labelled")
    n1, n0 = (lambda r: (r.a or 0, r.b or 0))(rows.agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).collect()[0])
    base = n1 / (n1 + n0) if n1 + n0 else 0.0
    if not n1 or not n0:
        scratch.close()
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), base)
    seen = rows.mapInArrow(_presence, "f long, y1 double, y0 double").groupBy("f").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0")).filter("y1 + y0 >= 2")
    share = PRIOR * (F.col("y1") + F.col("y0") + 0.5) / (n1 + n0 + 1)
    a1, a0 = F.col("y1") + share + 0.5, F.col("y0") + share + 0.5
    odds = F.ln(a1 / (n1 + PRIOR + 1 - a1)) - F.ln(a0 / (n0 + PRIOR + 1 - a0))
    z = odds / F.sqrt(1 / a1 + 1 / a0)
    top = seen.select("f", odds.alias("odds"), z.alias("z")).filter((F.col("z") > MIN_Z) & (F.col("odds") > MIN_ODDS) | (F.col("z") < -4)).toPandas()
    model = Model(top.f.to_numpy(np.int64).view(np.uint64), np.clip(top.odds.to_numpy(float), -1.0, CLIP), top.z.to_numpy(float), base)
    bg = rows.mapInArrow(lambda it: _background(it, model), "s double, n long").toPandas()
    model.calibrate(bg.s.to_numpy(float), bg.n.to_numpy(float))
    x = rows.select(F.col("toxic").cast("long").alias("doc_id"), "text").mapInArrow(lambda it: _evidence(it, model), EVIDENCE).select("doc_id", "evidence").toPandas()
    model.fit(x.evidence.to_numpy(float), x.doc_id.to_numpy(float))
    scratch.close()
    return model


EVIDENCE = "doc_id long, evidence double, score double, starts array<int>, ends array<int>"


def score_toxicity(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, calibrated evidence, score and the significant passages (token positions) of each document."""
    _common.ship(docs.sparkSession)
    docs = _common.columns(docs, doc_id="long", text="string")
    model = train(docs, labels, max_train)
    return docs.mapInArrow(lambda it: _evidence(it, model), EVIDENCE)


@_common.tidy
def _keep_clean(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        x = np.array([model.evidence(s, n) for _, n, s in passages(b, model)])
        yield b.filter(pa.array(model.score(x) < THRESHOLD)) if b.num_rows else b


def drop_toxic(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The documents whose score is below THRESHOLD, all columns kept."""
    _common.ship(docs.sparkSession)
    model = train(_common.columns(docs, doc_id="long", text="string"), labels, max_train)
    return docs.mapInArrow(lambda it: _keep_clean(it, model), docs.schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = score_toxicity(_common.table(spark, sf_dir, "documents"), _common.table(spark, sf_dir, "labels"))
    return got.select("doc_id", _common.held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("starts").alias("n_passages"))


QUERIES = {"op6_toxicity": op6_toxicity}
ORACLE: dict[str, str] = {}
