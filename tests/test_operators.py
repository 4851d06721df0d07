"""Operators on small frames: nulls, ties, missing columns, empty input, replays."""

import json

import pytest
from pyspark.sql import functions as F

from tipoff.functions import metrics, scalars
from tipoff.operators import aggregates, analysis, joins, quality, reshape, windows
from tipoff.plans.models import Model, distinct, passthrough, projection, run_models, staged_passthroughs, union
from tipoff.plans.questions import capped
from tipoff.sources import payloads, sinks
from tipoff.streaming import snapshots


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_clock_and_labels(spark):
    d = spark.createDataFrame([("12:30",), ("1:00:30",), ("",), ("bad",), ("7.5",), (None,)], "t string")
    assert [r[0] for r in rows(d.select(scalars.clock_minutes(F.col("t"))))] == [12.5, 60.5, None, None, 7.5, None]
    d = spark.createDataFrame([("2023",), ("22023",), ("2023-24",), ("2023-10-02",), ("2023-09-30",), ("x",)], "t string")
    assert [r[0] for r in rows(d.select(scalars.normal_season(F.col("t"))))] == ["2023-24"] * 4 + ["2022-23", None]
    assert scalars.snake_names(["GAME_ID", "teamCity", "PlayerID", "TO"], {"to": "tov"}) == ["game_id", "team_city", "player_id", "tov"]


def test_metrics_zero_and_null(spark):
    d = spark.createDataFrame([(10.0, 5.0, None), (0.0, 0.0, 0.0)], "a double, b double, c double")
    got = rows(d.select(metrics.true_shooting(F.col("a"), F.col("b"), F.col("c")), metrics.assist_to_turnover(F.col("a"), F.col("c"))))
    assert got == [(1.0, None), (0.0, None)]


def test_scd2_null_history(spark):
    d = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, None), (1, 4, None), (1, 5, "b"), (2, 1, "a")], "p int, s int, team string")
    got = windows.scd2(d, ["p"], [F.col("s")], ["team"], "s").orderBy("p", "s")
    assert rows(got.select("p", "s", "valid_to", "is_current")) == [(1, 1, 3, False), (1, 3, 4, False), (1, 4, 5, False), (1, 5, None, True), (2, 1, None, True)]


def test_dense_key_is_global(spark):
    d = spark.range(1000).select((F.col("id") * 7 % 1000).alias("x"))
    assert sorted(rows(windows.dense_key(d, ["x"], "k"))) == [(x, x + 1) for x in range(1000)]


def test_as_of_is_strictly_before(spark):
    f = spark.createDataFrame([(1, 5, "f"), (1, 1, "g"), (2, 9, "h")], "k int, at int, id string")
    h = spark.createDataFrame([(1, 5, 50), (1, 3, 30), (1, 1, 10)], "k int, at int, v int")
    assert sorted(rows(joins.as_of(f, h, ["k"], "at", "v", F.col("id")).select("id", "prior_v")), key=str) == [("f", 30), ("g", None), ("h", None)]


def test_families(spark):
    a, b = spark.createDataFrame([(1, 2.0)], "id int, x double"), spark.createDataFrame([(1, 3)], "id int, y int")
    assert sorted(rows(reshape.metric_family({"a": a, "b": b}, "v", ["id"]))) == [("a", 1, 2.0), ("b", 1, 3.0)]
    with pytest.raises(ValueError, match="one metric"):
        reshape.metric_family({"a": a.withColumn("z", F.lit(1))}, "v", ["id"])
    assert reshape.stack_family({"a": a, "b": b}, "v", {"id": "long", "w": "string"}).dtypes == [("v", "string"), ("id", "bigint"), ("w", "string")]
    g = spark.createDataFrame([("1-2-x",), (None,)], "g string")
    assert sorted(rows(reshape.split_ids(g, ["g"], "g", "-", "p")), key=str) == [("1-2-x", 1, 1), ("1-2-x", 2, 2), ("1-2-x", None, 3)]


def test_on_off_labels(spark):
    d = spark.createDataFrame([(1, " On", 5.0), (1, "OFF ", 2.0), (2, "on", 1.0)], "p int, s string, r double")
    assert rows(reshape.on_off(d, ["p"], "s", "On", "Off", ["r"])) == [(1, 5.0, 2.0, 3.0)]


def test_quality(spark):
    d = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "k int, v string")
    assert rows(aggregates.duplicate_count(d, ["k", "v"])) == [(1,)]
    assert quality.conform(d, {"k": "long", "z": "string"}, {"z"}).dtypes == [("k", "bigint"), ("z", "string")]
    with pytest.raises(ValueError, match="missing"):
        quality.conform(d, {"q": "int"})
    with pytest.raises(ValueError, match="removed"):
        quality.schema_changes({"k": "int", "old": "int"}, d)
    assert quality.schema_changes({"k": "int"}, d) == (["v"], [])
    even = spark.createDataFrame([("x", 5), ("y", 5)], "n string, c int")
    assert [r[3] for r in rows(quality.count_anomalies(even, "n", "c"))] == [False, False]
    assert rows(quality.low_counts(spark.createDataFrame([(1, 10), (2, 100), (3, 120)], "y int, n int"), "n")) == [(1, 10)]


def test_envelopes(spark, tmp_path):
    two = {"resultSets": [{"name": "Players", "headers": ["PLAYER_ID", "PTS"], "rowSet": [[1, 20], [2, None]]}, {"name": "Teams", "headers": ["TEAM_ID"], "rowSet": [[9]]}]}
    late = {"resultSets": [{"name": "Players", "headers": ["PTS", "PLAYER_ID", "NEW"], "rowSet": [["x", 3, 1]]}]}
    (tmp_path / "a.json").write_text(json.dumps(two, indent=1))
    (tmp_path / "b.json").write_text(json.dumps(late))
    got = payloads.read_envelopes(spark, str(tmp_path), {"Players": ["PLAYER_ID", "PTS"], "Teams": ["TEAM_ID"]}, {"player_id": "int", "pts": "int", "team_id": "int"})
    assert sorted(rows(got["Players"])) == [(1, 20), (2, None), (3, None)]
    assert rows(got["Teams"]) == [(9,)]


def test_discover_sets(spark):
    d = spark.createDataFrame([('{"a": {"b": [{"x": 1}, {"x": 2}]}, "c": [3]}',), ("not json",), (None,)], "j string")
    assert sorted(rows(payloads.discover_sets(d, "j").groupBy("path").count())) == [("$.a.b", 2), ("$.c", 1)]


def test_chunks_and_fan_out(spark, tmp_path):
    store = sinks.ChunkStore(spark, str(tmp_path / "c"))
    d = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert store.append("x", d) and not store.append("x", d.orderBy(F.desc("id")))
    with pytest.raises(ValueError, match="other content"):
        store.append("x", d.limit(1))
    store.append("y", d.select("id").withColumn("extra", F.lit(1)))
    assert store.materialize().count() == 4 and set(store.materialize().columns) == {"id", "v", "extra"}

    def broken(_):
        raise OSError("no space")

    assert [ok for _, ok, _ in sinks.fan_out(d, {"a": lambda x: x.count(), "b": broken})] == [True, False]
    with pytest.raises(OSError):
        sinks.fan_out(d, {"a": broken})


def test_stream_replay(spark, tmp_path):
    land, out, state = (str(tmp_path / x) for x in ("land", "out", "state"))
    d = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "id int, v string")
    d.write.parquet(land)
    for _ in range(2):
        snapshots.replay_snapshots(spark, land, out, state, ["id"], "live", d.schema)
    assert spark.read.parquet(out).count() == 1
    spark.createDataFrame([(2, "c")], d.schema).write.mode("append").parquet(land)
    snapshots.replay_snapshots(spark, land, out, state, ["id"], "live", d.schema)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 2]


def test_stateful_attempts(spark, tmp_path):
    land = str(tmp_path / "l")
    spark.createDataFrame([("a", False), ("a", True), ("b", False), ("c", False), ("c", False)], "key string, ok boolean").coalesce(1).write.parquet(land)
    s = spark.readStream.schema("key string, ok boolean").parquet(land)
    q = snapshots.stateful_attempts(s, 1).writeStream.format("memory").queryName("att").outputMode("update").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "s")).start()
    q.awaitTermination()
    assert sorted(rows(spark.sql("select key, status, retries from att"))) == [("a", "done", 1), ("b", "failed", 1), ("c", "abandoned", 1)]


def test_models(spark):
    d = spark.createDataFrame([(1,), (1,)], "id int")

    def bad(_):
        raise RuntimeError("boom")

    models = [Model("c", ["b"], lambda f: f["b"]), Model("b", ["a"], bad), passthrough("a", "stg"), distinct("d", "stg"), projection("p", "stg", {"key": "id"}), union("u", "kind", {"x": "stg", "y": "d"})]
    frames, report = run_models(models, {"stg": d})
    assert report.status == {"a": "ok", "b": "failed", "c": "skipped", "d": "ok", "p": "ok", "u": "ok"}
    assert frames["d"].count() == 1 and frames["p"].columns == ["key"] and frames["u"].count() == 3
    assert run_models(models, frames, done={"a", "d"})[1].status["a"] == "resumed"
    with pytest.raises(ValueError, match="depend on each other"):
        run_models([Model("a", ["b"], bad), Model("b", ["a"], bad)], {})
    assert [m.name for m in staged_passthroughs(["stg_x", "other"])] == ["fact_x"]


def test_analysis(spark):
    d = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 2.0), ("b", 2.0)], "g string, v double")
    assert rows(analysis.rank_sum(d, "g", "a", "b", "v"))[0][0] == 3.0
    curve = spark.createDataFrame([(float(x), 2.0 * 2.718281828459045 ** (-((x - 10) ** 2) / 50.0) + 1) for x in range(20)], "x double, y double")
    best = analysis.peak_fit(curve, "x", "y", [8.0, 10.0, 12.0], [3.0, 5.0]).collect()[0]
    assert (best.peak, best.width) == (10.0, 5.0) and abs(best.a - 2) < 1e-6
    assert capped(spark.range(20_000), 50_000).count() == 10_000


def test_empty_inputs(spark):
    e = spark.createDataFrame([], "k int, o int, v double")
    for df in (windows.first_of(e, ["k"], F.col("o")), windows.islands(e, ["k"], [F.col("o")], "v"), windows.z_scores(e, ["k"], ["v"]), windows.dense_key(e, ["o"], "n"), aggregates.top_values(e, "k")):
        assert df.count() == 0


def test_declared_outputs(spark):
    from tipoff.plans import outputs

    every = outputs.outputs()
    assert len({m.name for m in every}) == len(every) > 100
    one = spark.createDataFrame([(1, "a"), (1, "a")], "id int, v string")
    name, sources = next((o, s) for o, s in outputs.UNIONS.items() if len(s) > 1)
    frames, report = run_models(outputs.outputs(set(sources[:2])), {s: one for s in sources[:2]})
    assert report.status[name] == "ok"
    assert sorted({r.source for r in frames[name].collect()}) == sorted(outputs.label(s) for s in sources[:2])


def test_labelled_unions_and_projections(spark):
    from tipoff.plans import outputs

    staged = {"stg_all_time": spark.createDataFrame([(1, "a")], "pts int, x string"), "stg_all_time_ast": spark.createDataFrame([(2,)], "ast int"), "stg_scoreboard_ticket_links": spark.createDataFrame([("g", "t", 1)], "game_id string, leag_tix string, more int")}
    frames, report = run_models(outputs.outputs(set(staged)), staged)
    assert not report.errors
    assert sorted((r.stat_category, r.pts, r.ast, r.x) for r in frames["agg_all_time_leaders"].collect()) == [("ast", None, 2, None), ("combined", 1, None, "a")]
    assert frames["fact_scoreboard_ticket_links"].columns == ["game_id", "leag_tix"]
    assert {s for _, p, v in outputs.LABELLED.values() for s in outputs.branches(p, v).values()} >= {"stg_player_career_total_regular", "stg_player_shoot_5ft", "stg_summary_v3_officials"}


def test_dates_contexts_and_pictures(spark):
    from tipoff.plans import warehouse

    models = [m for m in warehouse.composed() if m.name in ("dim_date", "fact_game_context", "fact_playoff_picture")]
    df = lambda rows, kind: spark.createDataFrame(rows, kind)
    staged = {
        "stg_game_summary": df([("g1", 1), ("g2", 2)], "game_id string, a int"), "stg_game_info": df([("g1", 7), ("g1", 8)], "game_id string, b int"), "stg_other_stats": df([("g2", 9, 0)], "game_id string, z int, a int"),
        **{s: df([("g1",)], "game_id string") for s in ("stg_inactive_players", "stg_season_series", "stg_last_meeting", "stg_game_summary_available_video")},
    }
    for side, team in (("east", 1), ("west", 2)):
        staged |= {f"stg_playoff_picture_{side}": df([(team, "s")], "team_id int, seed string"), f"stg_playoff_picture_{side}_standings": df([(team, 5)], "team_id int, wins int"), f"stg_playoff_picture_{side}_remaining": df([(9, 1)], "team_id int, left int")}
    frames, report = run_models(models, staged)
    assert not report.errors
    days = {r.full_date: r for r in frames["dim_date"].filter("full_date in ('1946-01-01', '1999-10-01', '2000-09-30')").collect()}
    assert [(days[d].date_key, days[d].day_of_week, days[d].nba_season) for d in sorted(days)] == [(19460101, 2, "1945-46"), (19991001, 5, "1999-00"), (20000930, 6, "1999-00")]
    assert frames["dim_date"].columns == "date_key full_date year month day day_of_week day_name month_name is_weekend nba_season".split()
    got = sorted((r.context_source, r.game_id, r.a, r.b, r.z) for r in frames["fact_game_context"].collect() if r.context_source == "summary")
    assert got == [("summary", "g1", 1, 8, None), ("summary", "g2", 2, None, 9)] and frames["fact_game_context"].count() == 6
    assert sorted((r.conference, r.team_id, r.wins, r.left) for r in frames["fact_playoff_picture"].collect()) == [("East", 1, 5, None), ("West", 2, 5, None)]


def test_nearest_makes_no_pairs_and_equals_brute_force(spark):
    """Ties, hot places, nulls, keys of one side only."""
    import random

    rng = random.Random(4)
    at = lambda: rng.choice([None, -1.5, 0.0, 3.25, *(rng.randrange(-40, 40) / 8 for _ in range(6))])
    left = [(i, rng.randrange(4), at()) for i in range(400)] + [(1000 + i, 1, 0.5) for i in range(200)] + [(2000, None, 1.0)]
    right = [(i, rng.choice([0, 1, 1, 1, 2]), at()) for i in range(120)] + [(500, 4, None), (501, 5, 1.0), (499, 4, None)]
    left += [(3000, 4, 1.0), (3001, 4, None)]
    want = {}
    for i, k, z in left:
        near = sorted((z is None or w is None, abs(z - w) if z is not None and w is not None else 0.0, j) for j, q, w in right if q == k)
        if near:
            want[i] = (near[0][2], None if near[0][0] else near[0][1])
    a, b = spark.createDataFrame(left, "i long, k int, za double"), spark.createDataFrame(right, "j long, k int, zb double")
    got = joins.nearest(a, b, ["k"], "za", "zb", "j").collect()
    assert {r.i: (r.j, r.d) for r in got} == want and len(got) == len(want)


def test_prospects_of_null_balances_equal_sql(spark, tmp_path):
    """A distance of null comes last, as the SQL has it."""
    import duckdb

    from tipoff.plans import catalogue

    con = duckdb.connect()
    for t, k in (("customer", "c"), ("supplier", "s")):
        con.execute(f"copy (select * replace (case when {k}_{'custkey' if k == 'c' else 'suppkey'} % 3 > 0 then {k}_acctbal end as {k}_acctbal) from '/root/testdata/sf0.01/{t}.parquet') to '{tmp_path}/{t}.parquet' (format parquet)")
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
    got = sorted(map(tuple, catalogue.queries()["an_26_prospects"](spark, str(tmp_path)).select("c_custkey", "s_suppkey", "d").collect()), key=str)
    assert got == sorted(con.execute(catalogue.oracle_sql()["an_26_prospects"]).fetchall(), key=str) and any(r[2] is None for r in got)


def test_pairs_are_dealt_by_rows(spark, monkeypatch):
    """However small the rows are when compressed: a task pairs a fixed number of them."""
    monkeypatch.setattr(reshape, "PAIR_ROWS", 10, raising=False)
    df = spark.range(200).select((F.col("id") % 50).alias("g"), (F.col("id") % 7).alias("x"))
    got = reshape.pair_rows(df.hint("merge"), ["g"], "x", [])
    groups = [{k % 7 for k in range(g, 200, 50)} for g in range(50)]
    assert sorted((r.g, r.first_id, r.second_id) for r in got.collect()) == sorted((g, a, b) for g, s in enumerate(groups) for a in s for b in s if a < b)
    assert got.rdd.getNumPartitions() == 20
