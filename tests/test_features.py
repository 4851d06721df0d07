"""Features, pruned neighbours, best matches, whole exports."""

import math
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from tipoff.operators import analysis as N
from tipoff.operators import features as X
from tipoff.operators import windows as W
from tipoff.sources import sinks


def vectors(spark, clusters, n, dim=8, spread=0.05, seed=1):
    g = np.random.default_rng(seed)
    centres = g.standard_normal((clusters, dim))
    v = centres[np.arange(n) % clusters] + spread * g.standard_normal((n, dim))
    return [(i, "ab"[i % 7 == 0], x) for i, x in enumerate(v.tolist())]


def edges(df):
    return {(r.src, r.dst) for r in df.collect()}


def test_pruned_edges_equal_all_pairs(spark):
    rows = vectors(spark, 24, 1200) + [(5000, "a", [0.0] * 8), (5001, "a", None), (5002, None, [1.0] * 8), (5003, "c", [1.0] * 8), (5004, "a", vectors(spark, 24, 1)[0][2])]
    df = spark.createDataFrame(rows, "id long, g string, v array<double>")
    got, pairs = N.pruned_edges(df, "id", "v", "g", block=32)
    assert edges(got) == edges(N.similarity_edges(df, "id", "v", "g", block=200))
    n, looked = pairs.agg(F.count(F.lit(1)), F.count_if("looked")).first()
    assert n > 500 and looked < 0.35 * n
    loose = spark.createDataFrame(vectors(spark, 1, 300, spread=3.0), df.schema)
    assert edges(N.pruned_edges(loose, "id", "v", "g", block=32)[0]) == edges(N.similarity_edges(loose, "id", "v", "g"))
    assert N.pruned_edges(df.filter("false"), "id", "v", "g")[0].count() == 0


def test_best_matches(spark):
    rows = vectors(spark, 9, 90, spread=1.0)
    df = spark.createDataFrame(rows, "id long, g string, v array<double>")
    got = {r.src: r.dst for r in N.best_matches(df.filter("id < 40"), df.filter("id >= 40"), "id", "v", 7).collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, _, v in rows}
    assert got == {i: max(range(40, 90), key=lambda j: (unit[i] @ unit[j], -j)) for i in range(40)}


def test_scores_beside_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 9.0), ("b", 2.0)], "k string, v double")
    z = sorted((r.k or "", r.v, round(r.v_z, 6)) for r in W.z_scores(df, ["k"], ["v"]).collect())
    assert z == [("", 5.0, -0.707107), ("", 9.0, 0.707107), ("a", 1.0, -0.707107), ("a", 3.0, 0.707107), ("b", 2.0, 0.0)]
    assert sorted(r.v_scaled for r in W.min_max(df, [], "v", 8.0).collect()) == [0.0, 1.0, 2.0, 4.0, 8.0]


def test_game_features_know_nothing_of_the_game(spark):
    r = random.Random(3)
    games = [(i, i, 2000 + i // 40, *r.sample(range(5), 2), float(r.randrange(80, 120)), float(r.randrange(80, 120))) for i in range(120)]
    df = spark.createDataFrame(games, "game_id long, k int, season int, home int, away int, pts_home double, pts_away double").withColumn("day", F.date_add(F.lit("2000-01-01").cast("date"), "k")).drop("k")
    box = [(g[0], t, float(g[0] * 10 + t)) for g in games for t in (g[3], g[4])]
    got = {x.game_id: x for x in X.game_features(df, spark.createDataFrame(box, "game_id long, team int, m double"), ["m"], 3).collect()}
    for i, _, season, home, away, ph, pa in games:
        past = {t: [g for g in games[:i] if t in g[3:5]] for t in (home, away)}
        if not past[home] or not past[away]:
            assert i not in got
            continue
        mean = lambda t, past=past: sum(g[0] * 10 + t for g in past[t][-3:]) / len(past[t][-3:])
        assert math.isclose(got[i].home_m, mean(home)) and math.isclose(got[i].m_diff, mean(home) - mean(away)) and got[i].target == int(ph > pa)
        met = [g for g in games if {g[3], g[4]} == {home, away} and g[2] < season]
        last = [g for g in met if g[2] == max(g[2] for g in met)] if met else []
        assert got[i].h2h_games == (len(last) or None)
        if last:
            assert got[i].h2h_wins == sum((g[5] > g[6]) if g[3] == home else (g[6] > g[5]) for g in last)


def test_stint_pairs(spark):
    s = spark.createDataFrame([("g", 0, 300, 4), ("g", 300, 330, 9), ("g", 400, 640, -2), ("g", 700, 790, 5), ("h", 0, 600, 1)], "k string, a int, b int, d int")
    assert [(r.prev_diff, r.prev_min, r.next_diff, r.next_min, r.prev_rate, r.next_rate) for r in X.stint_pairs(s, ["k"], "a", "b", "d").collect()] == [(4, 5.0, -2, 4.0, 0.8, -0.5)]


def test_curves_are_whole(spark):
    rows = [("flat", i, 1.0) for i in range(9)] + [("wild", i, (-1.0) ** i * i) for i in range(9)] + [("wild", 9, None), ("few", 1, 100.0), ("mid", 0, 1.0)] + [("mid", i, float(i)) for i in range(1, 6)]
    got = X.volatile_curves(spark.createDataFrame(rows, "g string, i int, v double"), "g", "v", [F.col("i")], ["i", "v"], 5, 2).collect()
    assert {(r.g, r.drama_rank) for r in got} == {("wild", 1), ("mid", 2)} and len(got) == 15 and all(r.event_idx == r.i + 1 for r in got if r.g == "wild")


def test_composites_are_compared(spark):
    r = random.Random(2)
    rows = [(i, *(r.random() * 100 for _ in range(3))) for i in range(50)]
    p = spark.createDataFrame([(*x, 0.35 * x[1] + 0.35 * x[2] + 0.3 * x[3]) for x in rows], "id long, score0 double, score1 double, score2 double, composite double")
    on = spark.createDataFrame([(i, x[1]) for i, x in enumerate(rows)], "id long, d double")
    got = X.composite_check(p, "id", on, "d").first()
    w, e = (np.array([f(x) for x in rows]) for f in (lambda x: 0.35 * x[1] + 0.35 * x[2] + 0.3 * x[3], lambda x: sum(x[1:]) / 3))
    assert math.isclose(got.with_equal, np.corrcoef(w, e)[0, 1]) and math.isclose(got.with_on_off, np.corrcoef(w, [x[1] for x in rows])[0, 1])
    assert got.same_top_ten == len(set(np.argsort(-w)[:10]) & set(np.argsort(-e)[:10]))


def test_exports_say_what_failed(spark, tmp_path):
    db, base = f"export_{uuid.uuid4().hex[:8]}", f"file://{tmp_path}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{base}/db'")
    with pytest.raises(ValueError, match="no table"):
        sinks.export_all(spark, db, f"{base}/out", ["csv"])
    for name, df in {"good": spark.range(3), "wide": spark.range(2).select(F.array("id").alias("a")), "_own": spark.range(1)}.items():
        df.write.saveAsTable(f"{db}.{name}")
    with pytest.raises(ValueError, match="unsupported"):
        sinks.export_all(spark, db, f"{base}/out", ["xml"])
    report = sinks.export_all(spark, db, f"{base}/out", ["parquet", "csv"], allow_partial=True)
    assert [r[:3] for r in report] == [("good", "parquet", True), ("good", "csv", True), ("wide", "parquet", True), ("wide", "csv", False)]
    with pytest.raises(RuntimeError, match="wide"):
        sinks.export_all(spark, db, f"{base}/out", ["csv"])
    assert spark.read.parquet(f"{base}/out/parquet/good").count() == 3
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_percent_ranks_by_ranges(spark):
    r = random.Random(9)
    rows = [(i, r.choice(["a", "b", None]), r.choice([None, *map(float, range(9))])) for i in range(300)]
    got = {x.i: (x.pct_rank, x.share_below) for x in W.percent_ranks(spark.createDataFrame(rows, "i int, k string, v double"), ["k"], "v").collect()}
    for i, k, v in rows:
        mine = [x for _, g, x in rows if g == k]
        low = sum((x is not None and (v is None or x < v)) for x in mine)
        ties = sum(x == v for x in mine)
        assert math.isclose(got[i][1], low / len(mine)) and abs(got[i][0] - (low + 1 + (ties - 1) / 2) / len(mine) * 100) <= 0.05 + 1e-9


def test_era_edges_join_few_pairs_of_blocks(spark):
    """Directions of three numbers: with about a pivot for each block, most pairs of blocks are ruled out, and the edges are those of all pairs."""
    df = spark.range(6000).selectExpr("id", "array(sin(id * 7.3), cos(id * 3.1), sin(id * 1.7 + 1)) as v", "0 as g")
    got, pairs = N.pruned_edges(df, "id", "v", "g", block=64)
    n = pairs.agg(F.count(F.lit(1)), F.count_if("looked")).collect()[0]
    assert n[1] < 0.35 * n[0]
    want = {(r.src, r.dst) for r in N.similarity_edges(df, "id", "v", "g").select("src", "dst").collect()}
    assert {(r.src, r.dst) for r in got.select("src", "dst").collect()} == want and len(want) == 18000
