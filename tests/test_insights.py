"""Exact selection, tails and tests, checks from schemas, coverage and work plans."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tipoff.functions import statistics as ST
from tipoff.operators import quality as Q
from tipoff.operators import selection
from tipoff.operators import significance as S


def quantile(values, p):
    v = sorted(values)
    at = p * (len(v) - 1)
    lo, hi = math.floor(at), math.ceil(at)
    return v[lo] + (v[hi] - v[lo]) * (at - lo) if v else None


@pytest.mark.parametrize(("limit", "cuts"), [(1 << 20, 128), (5, 4), (40, 8)])
def test_quantiles_are_exact(spark, limit, cuts, monkeypatch):
    monkeypatch.setattr(selection.ranked, "__defaults__", (limit, cuts))
    r = random.Random(4)
    groups = {"a": [r.random() for _ in range(3000)], "b": [float(r.randrange(3)) for _ in range(700)], None: [7.5], "d": [], "e": [1.0] * 500 + [2.0], "f": [-(2.0**k) for k in range(60)]}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    points = {"p0": 0.0, "p1": 0.013, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {x.k: x for x in selection.quantiles(df, ["k"], "v", points, limit).collect()}
    assert set(got) == set(groups)
    for k, vs in groups.items():
        for n, p in points.items():
            want = quantile(vs, p)
            assert (got[k][n] is None) == (want is None) and (want is None or abs(got[k][n] - want) <= 1e-9 * max(1, abs(want)))


def test_profiles(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else "abc"[i % 3], i / 2, i % 2 == 0) for i in range(60)], "n int, s string, x double, b boolean")
    p = {r.column: r for r in selection.profile(df).collect()}
    assert (p["s"].nulls, p["s"].distinct, p["s"].rows) == (15, 3, 60) and p["s"].top == "a=15,b=15,c=15" and p["s"].p50 is None
    assert (p["n"].min, p["n"].max, p["n"].p50, p["n"].top) == (0.0, 59.0, 29.5, None) and p["b"].top == "false=30,true=30"
    none = {r.column: r for r in selection.profile(df.filter("false").select("s")).collect()}
    assert none == {}


def test_tails_equal_tabled_values(spark):
    #: Upper normal tails, and two-sided tails of Student's t by t and degrees of freedom.
    normal = {0.0: 0.5, 1.0: 0.15865525393145707, 1.959963984540054: 0.025, 3.0: 0.0013498980316300933, 5.0: 2.866515718791933e-07, 8.0: 6.220960574271785e-16}
    student = {(12.706204736432095, 1.0): 0.05, (2.2281388519649385, 10.0): 0.05, (2.5758293035489004, 1e9): 0.01, (1.0, 1.0): 0.5, (0.0, 7.0): 1.0, (2.0, 4.0): 0.1161165235168156, (-2.0, 4.0): 0.1161165235168156}
    for z, want in normal.items():
        got = spark.range(1).select(ST.normal_upper(F.lit(z))).first()[0]
        assert abs(got - want) < 1e-12 + 1e-9 * want
    for (t, v), want in student.items():
        assert abs(spark.range(1).select(ST.student_two_sided(F.lit(t), F.lit(v))).first()[0] - want) < 1e-7
    for x in (0.5, 1.0, 3.5, 40.0, 2e4):
        assert abs(spark.range(1).select(ST.log_gamma(F.lit(x))).first()[0] - math.lgamma(x)) < 1e-9 * max(1, abs(math.lgamma(x)))
    low, high = (spark.range(1).select(ST.student_two_sided(F.lit(1.7), F.lit(v))).first()[0] for v in (19_999.0, 20_001.0))
    assert abs(low - high) < 1e-7


def test_verdicts(spark):
    df = lambda a, b: spark.createDataFrame([("a", float(v)) for v in a] + [("b", float(v)) for v in b] + [("a", None), ("c", 1.0)], "g string, v double")
    one = S.difference(df(range(10), range(20, 30)), "g", "a", "b", "v").first()
    assert one.significant and one.effect_label == "large" and one.n_a == 10 and one.summary.startswith("Significant difference (p=0.0000, Welch's t-test).")
    few = S.difference(df([1, 2], [3, 4, 5]), "g", "a", "b", "v").first()
    assert few.p_value is None and few.significant is None and few.summary is None
    flat = S.difference(df([1] * 5, [1] * 5), "g", "a", "b", "v").first()
    assert flat.p_value is None and flat.effect_size == 0.0
    ranks = S.difference(df([1, 2, 3, 4], [1, 2, 3, 4]), "g", "a", "b", "v", S.RANKS).first()
    assert ranks.p_value == 1.0 and ranks.significant is False and ranks.statistic == 8.0
    with pytest.raises(ValueError, match="unknown"):
        S.difference(df([1], [1]), "g", "a", "b", "v", "other")


def test_streak_verdicts(spark):
    rows = [("hot", i, int(i < 15)) for i in range(30)] + [("all", i, 1) for i in range(12)] + [("few", i, i % 2) for i in range(6)] + [("turns", i, i % 2) for i in range(40)]
    s = {r.k: r for r in S.streaks(spark.createDataFrame(rows, "k string, i int, w int"), ["k"], [F.col("i")], "w").collect()}
    assert (s["hot"].longest, s["hot"].runs, s["hot"].significant) == (15, 2, True) and abs(s["hot"].expected_longest - math.log(30) / math.log(2)) < 1e-9
    assert (s["all"].expected_longest, s["all"].p_value) == (12.0, None) and s["few"].significant is None and s["turns"].significant
    cold = {r.k: r for r in S.streaks(spark.createDataFrame(rows, "k string, i int, w int"), ["k"], [F.col("i")], "w", "cold").collect()}
    assert cold["all"].longest == 0 and cold["all"].expected_longest == 0.0 and cold["hot"].longest == 15


def test_checks_from_schemas(spark):
    zero = spark.createDataFrame([(1, 2, 0, 0.0, 0, None, 0)] * 2 + [(k, None, 1, 0.0, 0, 0, 0) for k in range(3, 10)], "game_id long, team_id long, a int, b double, c int, d long, e int")
    got = {(r.table, r.check, r.columns): r for r in Q.schema_checks({"fact": zero, "other": zero.drop("game_id")}, {"team_id"}, {"fact"}, named=("game_id", "team_id")).collect()}
    assert got[("fact", "null_key_column", "team_id")].severity == "error"
    assert (got[("fact", "duplicate_keys", "game_id,team_id")].n, got[("fact", "duplicate_keys", "game_id,team_id")].severity) == (1, "warning")
    assert (got[("fact", "zero_stat_rows", "a,b,c,d,e")].n, got[("fact", "zero_stat_rows", "a,b,c,d,e")].severity) == (2, "info")
    assert ("other", "zero_stat_rows", "a,b,c,d,e") not in got
    assert Q.inferred_keys(["x_id", "y", "z_id"]) == ["x_id", "z_id"] and Q.inferred_keys(["team_id", "x_id"]) == ["team_id"]
    assert Q.schema_checks({"t": zero.select("a")}, set(), set()) is None


def test_the_last_attempt_of_a_scope_counts(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    journal = spark.createDataFrame([("a", "failed", 1), ("a", "done", 2), ("b", "done", 1), ("b", "failed", 2)], "k string, status string, n int")
    got = {r.k: r.coverage for r in Q.status_matrix(keys, keys.select("k", F.lit(1).alias("rows")), journal, ["k"], "n").collect()}
    assert got == {"a": "complete", "b": "present_after_failure"}


def test_coverage_rules(spark):
    e = lambda *r: spark.createDataFrame(list(r), "table string, endpoint string, season string, type string, staged boolean")
    a = spark.createDataFrame([("t", "20", "r", 5), ("u", "20", None, 7)], "table string, season string, type string, rows long")
    j = spark.createDataFrame([("x", "20", "p", "i", 1, "failed", 0), ("x", "20", "p", "i", 2, "done", 0), ("x", "21", None, "i", 1, "abandoned", 0), ("y", "20", "r", "i", 1, "done", 9), ("x", "22", "r", "i", 1, "failed", 0)], "endpoint string, season string, type string, item string, attempt int, status string, rows long")
    t = spark.createDataFrame([("t", True, True, 5), ("u", True, False, 7), ("v", False, False, 3)], "table string, has_season boolean, has_type boolean, rows long")
    expected = e(("t", "x", "20", "r", True), ("t", "x", "20", "p", True), ("t", "x", "20", None, True), ("t", "x", "21", "r", True), ("t", "x", "22", "p", True), ("t", "x", "23", "r", True), ("u", "x", "20", "r", True), ("v", "y", "20", "r", True), ("w", "x", "20", "r", True), ("w", "x", "20", "r", False))
    got = sorted((r.table, r.season, r.type or "", r.status, r.rows) for r in Q.coverage_status(expected, a, j, t).collect())
    assert got == sorted([("t", "20", "r", "present", 5), ("t", "20", "p", "empty_valid", 0), ("t", "20", "", "present", 5), ("t", "21", "r", "abandoned", 0), ("t", "22", "p", "failed", 0), ("t", "23", "r", "missing", 0), ("u", "20", "r", "present_untyped", 7), ("v", "20", "r", "present_inferred", 9), ("w", "20", "r", "missing_table", 0), ("w", "20", "r", "contract_gap", 0)])


def test_work_plans_are_balanced(spark):
    r = random.Random(1)
    rows = [(i, y, k) for i in range(101) for y in range(r.randrange(1, 9)) for k in r.sample("abc", r.randrange(1, 4))]
    plan = Q.work_plan(spark.createDataFrame([*rows, *rows[:5], (None, 1, "a")], "i long, y int, k string"), "i", "y", "k", 5).collect()
    back = Counter((p.i, int(y), k) for p in plan for y in p.seasons.split(",") for k in p.types.split(","))
    assert back == Counter(set(rows)) and len({(p.i, p.types) for p in plan}) == len(plan)
    loads = Counter()
    for p in plan:
        loads[p.shard] += p.load
    largest = max(Counter({p.i: sum(q.load for q in plan if q.i == p.i) for p in plan}).values())
    assert len(loads) == 5 and max(loads.values()) - min(loads.values()) <= largest


def test_selection_gets_past_a_value_that_fills_a_range(spark, monkeypatch):
    """Cuts by share of rows alone are all that value, and a round would leave its range as it was; weights count as rows do."""
    monkeypatch.setattr(selection.ranked, "__defaults__", (8, 4))
    df = spark.range(5000).select((F.when(F.col("id") < 60, F.col("id").cast("double")).otherwise(1e6)).alias("v"), F.lit(3).alias("w"))
    got = selection.quantiles(df, [], "v", {"lo": 0.0, "low": 0.005, "p50": 0.5, "hi": 1.0}, 8).collect()[0]
    assert (got.lo, round(got.low, 6), got.p50, got.hi) == (0.0, 24.995, 1e6, 1e6)
    one = selection.quantiles(spark.createDataFrame([(1.0, 3), (2.0, 1)], "v double, w long"), [], "v", {"p50": 0.5, "p90": 0.9}, weight="w").collect()[0]
    assert one.p50 == 1.0 and round(one.p90, 6) == 1.7


def test_profile_counts_values_in_their_own_type(spark):
    """0.0 and -0.0 are one value, as in SQL; as texts they were two."""
    p = {r.column: r for r in selection.profile(spark.createDataFrame([(0.0, "a"), (-0.0, "a"), (None, "b")], "x double, s string")).collect()}
    assert p["x"].distinct == 1 and p["x"].nulls == 1 and p["x"].rows == 3 and p["s"].top == "a=2,b=1"
