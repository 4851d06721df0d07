"""Stored runs, loads, journals, schema histories and analyses against plain Python."""

import datetime as dt
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tipoff.operators import analysis as N
from tipoff.operators import quality as Q
from tipoff.operators import windows as W
from tipoff.plans import catalogue
from tipoff.plans.load import Load, load_tables
from tipoff.plans.models import Model, RunStore, run_summary, slowest
from tipoff.sources import payloads, sinks
from tipoff.streaming import snapshots

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_run_store_resumes_and_forgets(spark, tmp_path):
    d, calls = spark.range(5), []

    def build(name, fail=False):
        def f(frames):
            calls.append(name)
            if fail:
                raise RuntimeError(f"{name} broke")
            return frames["in"].withColumn(name, F.lit(1))

        return f

    models = lambda fail: [Model("a", ["in"], build("a")), Model("b", ["in"], build("b", fail)), Model("c", ["a", "b"], lambda f: f["a"].join(f["b"], "id"))]
    store = RunStore(spark, str(tmp_path), "r1")
    _, report = store.run(models(True), {"in": d})
    assert report.status == {"a": "ok", "b": "failed", "c": "skipped"} and "b broke" in report.errors["b"]
    frames, report = RunStore(spark, str(tmp_path), "r1").run(models(False), {"in": d})
    assert report.status == {"a": "resumed", "b": "ok", "c": "ok"} and calls == ["a", "b", "b"]
    assert frames["c"].count() == 5
    _, other = RunStore(spark, str(tmp_path), "r2").run(models(False), {"in": d})
    assert set(other.status.values()) == {"ok"}
    log = store.log()
    assert rows(run_summary(log).select("run_id", "ok", "failed", "skipped", "rows")) == [("r1", 3, 1, 1, 15), ("r2", 3, 0, 0, 15)]
    assert slowest(log, 2).count() == 4
    store.clear()
    assert set(RunStore(spark, str(tmp_path), "r1").run(models(False), {"in": d})[1].status.values()) == {"ok"}


def test_load_isolates_failures(spark, tmp_path):
    d = spark.createDataFrame([(1, 5.0), (3, None)], "id int, v double")

    def broken(_):
        raise OSError("disk full\nat line 2")

    loads = {
        "good": Load(d, "id", {"v": F.col("v") > 0, "id": F.col("id") > 0}, {"again": lambda x: x.count()}), "half": Load(d, None, {}, {"bad": broken}),
        "bad": Load(d.select(F.raise_error(F.lit("boom")).alias("x"))), "empty": Load(d.limit(0), "id", {"id": F.col("id") > 0}),
    }
    got = {r.table: r for r in load_tables(spark, loads, str(tmp_path / "x")).collect()}
    assert (got["good"].status, got["good"].rows, got["good"].mark, got["good"].score, got["good"].sinks) == ("ok", 2, "3", 50.0, "parquet,again")
    assert (got["half"].status, got["half"].error) == ("partial", "bad: disk full") and got["bad"].status == "failed" and "boom" in got["bad"].error
    assert (got["empty"].status, got["empty"].rows, got["empty"].mark, got["empty"].score) == ("ok", 0, None, 100.0)
    assert {r.table: r.status for r in load_tables(spark, {"half": loads["half"]}, str(tmp_path / "y"), strict=True).collect()} == {"half": "failed"}
    assert spark.read.parquet(str(tmp_path / "x/_metadata")).count() == 4


def test_chunk_journal_outlives_the_store(spark, tmp_path):
    d = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    path = str(tmp_path / "c")
    assert sinks.ChunkStore(spark, path).append("x", d)
    d.write.parquet(f"{path}/chunk-cut-short")  # written, but never entered
    store = sinks.ChunkStore(spark, path)
    assert not store.append("x", d) and store.materialize().count() == 2
    with pytest.raises(ValueError, match="other content"):
        store.append("x", d.limit(1))
    assert store.append("x", d.limit(1), replace=True) and sinks.ChunkStore(spark, path).materialize().count() == 1


def test_schema_versions(spark):
    seen = {1: ["a:int", "b:int"], 2: ["a:int", "b:int"], 3: ["a:int", "b:long", "c:int"], 5: ["a:int"], 6: ["a:int", "b:int"]}
    data = [("t", k, *x.split(":")) for k, cols in seen.items() for x in cols] + [("u", 1, "z", "int")]
    v = Q.schema_versions(spark.createDataFrame(data, "table string, at int, column string, type string"), ["table"], "at", allowed=F.col("at") == 3)
    got = [(r.at, r.version, r.drifted, r.added, r.removed, r.refused) for r in v.filter("table = 't'").orderBy("at").collect()]
    assert got == [
        (1, 1, False, None, None, False), (2, 1, False, [], [], False), (3, 2, True, ["b:long", "c:int"], ["b:int"], False),
        (5, 3, True, [], ["b:long", "c:int"], True), (6, 4, False, ["b:int"], [], False),
    ]


def test_scores_anchors_parity(spark):
    r = spark.createDataFrame([("a", "keys", "k1", True), ("a", "keys", "k2", False), ("a", "range", "r", None), ("a", "range", "q", True), ("b", "keys", "k", True)], "table string, layer string, check string, passed boolean")
    assert rows(Q.quality_scores(r)) == [("a", 4, 2, 50.0, "keys:k2,range:r"), ("b", 1, 0, 100.0, "")]
    counts = spark.createDataFrame([("x", 0), ("y", 5)], "name string, n long")
    domains = spark.createDataFrame([("d1", "x"), ("d1", "y"), ("d2", "x"), ("d3", "q")], "domain string, name string")
    assert rows(Q.anchors(counts, domains)) == [("d1", 2, 2, "ok"), ("d2", 1, 1, "empty"), ("d3", 1, 0, "missing")]
    assert rows(Q.parity(counts, {"all": counts, "some": counts.filter("n > 0")})) == [("all", 2, 2, True), ("some", 2, 1, False)]


def test_attempt_states(spark):
    at = lambda h: dt.datetime(2024, 1, 10) + dt.timedelta(hours=h)
    log = [("a", "start", 0), ("a", "failure", 1), ("a", "success", 2), ("b", "failure", 0), ("b", "start", 5), ("c", "start", 1), ("d", "failure", 1), ("d", "failure", 2), ("e", "failure", 3), ("f", "note", 4), ("a", "note", 9)]
    d = spark.createDataFrame([(k, x, i, at(h)) for i, (k, x, h) in enumerate(log)], "k string, kind string, i int, ts timestamp")
    now = F.lit(at(6)).cast("timestamp")
    got = snapshots.attempt_states(d, ["k"], "i", "ts", F.col("kind"), 2, now, "3 hours")
    assert rows(got) == [("a", "done", 1), ("b", "running", 1), ("c", "pending", 0), ("d", "abandoned", 2), ("e", "failed", 1)]


def test_discover_sets_at_any_depth(spark):
    """Against a recursive walk in Python, nested nine deep."""

    def walk(x, path, out):
        if isinstance(x, dict):
            for k, v in x.items():
                walk(v, f"{path}.{k}", out)
        elif isinstance(x, list):
            for v in x:
                if v is not None:
                    out.append((path, json.dumps(v, separators=(",", ":"))))
                    walk(v, path, out)
        return out

    r = random.Random(4)

    def make(depth):
        if depth == 0:
            return r.choice([1, "x", True])
        return {f"k{r.randrange(3)}": make(depth - 1) for _ in range(2)} if r.random() < 0.5 else [make(depth - 1) for _ in range(r.randrange(3))]

    texts = [json.dumps(make(9)) for _ in range(12)] + ['{"a": {"b": {"c": {"d": {"e": [{"f": [7]}]}}}}}']
    want = [(p, json.loads(v)) for t in texts for p, v in walk(json.loads(t), "$", [])]
    got = payloads.discover_sets(spark.createDataFrame([(t,) for t in texts], "j string"), "j").collect()
    plain = lambda pairs: sorted(json.dumps(x, sort_keys=True) for x in pairs)
    assert plain((x.path, json.loads(x.row)) for x in got) == plain(want)
    assert ("$.a.b.c.d.e.f", 7) in want


def test_similarity_edges_in_blocks(spark):
    """Blocks far smaller than a group, ties, copies and a vector without direction, against brute force."""
    r = np.random.default_rng(3)
    v = {i: r.normal(size=5).round(1).tolist() for i in range(60)}
    v |= {60: v[3], 61: v[3], 62: [0.0] * 5, 63: [2 * x for x in v[3]]}
    df = spark.createDataFrame([(i, i % 2, x) for i, x in v.items()], "id long, g int, v array<double>")
    got = {}
    for e in N.similarity_edges(df, "id", "v", "g", block=7).orderBy("src", F.desc_nulls_last("cosine"), "dst").collect():
        got.setdefault(e.src, []).append(e.dst)
    for i, x in v.items():
        cos = []
        for j, y in v.items():
            if j != i and j % 2 == i % 2:
                a, b = np.array(x), np.array(y)
                n = np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())
                cos.append((-round(float((a * b).sum() / n), 9) if n else 9.0, j))
        assert got[i] == [j for _, j in sorted(cos)[:3]], i
    assert N.similarity_edges(df.limit(0), "id", "v", "g").count() == 0


def test_ranks_over_ranges(spark):
    r = random.Random(1)
    data = [(r.choice("ab"), float(r.randrange(40))) for _ in range(500)]
    got = N.rank_sum(spark.createDataFrame(data, "g string, v double").repartition(5), "g", "a", "b", "v").collect()[0]
    u = sum((x > y) + 0.5 * (x == y) for g, x in data if g == "a" for h, y in data if h == "b")
    assert got.u == u
    keys = W.dense_key(spark.createDataFrame(data, "g string, v double"), ["v", "g"], "k")
    assert sorted(x.k for x in keys.collect()) == list(range(1, 501)) and [x.v for x in keys.orderBy("k").collect()] == sorted(v for _, v in data)


def blobs(spark, centres, n=60):
    r = np.random.default_rng(0)
    return spark.createDataFrame([(k, (np.array(c) + r.normal(scale=0.4, size=len(c))).tolist()) for k, c in enumerate(centres) for _ in range(n)], "kind int, v array<double>")


def purity(df):
    pairs = {(r.kind, r.cluster) for r in df.select("kind", "cluster").distinct().collect()}
    return len(pairs) == len({k for k, _ in pairs}) == len({c for _, c in pairs})


def test_clusters_and_mixtures_find_separate_groups(spark):
    d = blobs(spark, [(0, 0), (9, 0), (0, 9)])
    best, score = N.clusters(d, "v", [2, 3, 4])
    assert max(score, key=score.get) == 3 and purity(best)
    best, score = N.mixtures(d, "v", [2, 3, 4])
    assert min(score, key=lambda k: score[k][0]) == 3 and purity(best)


def test_mixture_bic_by_hand(spark):
    """BIC of one fit, from densities summed in numpy."""
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.functions import array_to_vector

    d = blobs(spark, [(0, 0), (5, 5)], 40)
    _, score = N.mixtures(d, "v", [2])
    x = np.array([r.v for r in d.collect()])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    zd = spark.createDataFrame([(p.tolist(),) for p in z], "v array<double>").withColumn("x", array_to_vector("v"))
    m = GaussianMixture(k=2, seed=7, featuresCol="x", maxIter=50, tol=1e-3).fit(zd)
    total = 0.0
    for p in z:
        s = 0.0
        for w, g in zip(m.weights, m.gaussians):
            c = np.array(g.cov.toArray())
            e = p - np.array(g.mean.toArray())
            s += w * math.exp(-0.5 * e @ np.linalg.solve(c, e)) / math.sqrt((2 * math.pi) ** 2 * np.linalg.det(c))
        total += math.log(s)
    assert abs(score[2][0] - (-2 * total + (1 + 2 * 2 + 2 * 3) * math.log(len(z)))) < 0.5


def test_components_profile_by_hand(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(80, 4)) @ np.diag([3, 2, 1, 0.5]) + r.normal(size=(80, 1))
    out = N.components_profile(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id int, v array<double>"), "v").orderBy("id").collect()
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    _, vec = np.linalg.eigh(np.cov(z.T))
    total = np.zeros(80)
    for k, w in enumerate((0.35, 0.35, 0.3)):
        a = vec[:, -1 - k]
        a = a * np.sign(a[np.abs(a).argmax()])
        p = z @ a
        s = 100 * (p - p.min()) / (p.max() - p.min())
        assert np.allclose([o[f"score{k}"] for o in out], s, atol=1e-6)
        total += w * s
    assert np.allclose([o.composite for o in out], total, atol=1e-6)


def test_peak_by_hand(spark):
    """The registered curve fit: every peak and width by ordinary least squares in numpy."""
    part = spark.read.parquet(f"{SF}/part.parquet").groupBy("p_size").agg(F.avg("p_retailprice").alias("m")).collect()
    x, y = np.array([float(r.p_size) for r in part]), np.array([r.m for r in part])
    best = None
    for p in range(5, 50, 5):
        for w in (2.0, 5.0, 10.0, 20.0):
            a = np.c_[np.exp(-((x - p) ** 2) / (2 * w * w)), np.ones(len(x))]
            sse = float(((a @ np.linalg.lstsq(a, y, rcond=None)[0] - y) ** 2).sum())
            best = min(best or (sse, p, w), (sse, p, w))
    got = catalogue.queries()["an_12_peak"](spark, SF).collect()[0]
    assert (got.peak, got.width) == (float(best[1]), best[2]) and abs(got.sse - best[0]) < 1e-6 * best[0]


def test_distance_similarity(spark):
    d = spark.createDataFrame([(1, 1.0, 5.0, "g"), (2, 2.0, 5.0, "g"), (3, 1.0, 5.0, "f"), (4, 9.0, 5.0, "g")], "id int, a double, b double, pos string")
    assert [r.id for r in N.similar_by_distance(d, "id", ["a", "b"], 1).collect()] == [3, 2, 4]
    by = {r.id: r.similarity for r in N.similar_by_distance(d, "id", ["a", "b"], 1, position="pos").collect()}
    assert abs(by[3] - 0.5) < 1e-12 and by[2] > by[3]
