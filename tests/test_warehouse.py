"""The composed models on a small league, against sums in plain Python."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tipoff.plans import warehouse
from tipoff.plans.models import run_models

TEAMS, PLAYERS = [1, 2, 3], {11: 1, 12: 1, 21: 2, 22: 2, 31: 3}
GAMES = [(f"g{k}", f"2024-01-{10 + k:02d}", "2023-24", "Regular Season" if k < 12 else "Playoffs", *random.Random(k).sample(TEAMS, 2)) for k in range(14)]
STATS = ["min", *warehouse.SHOOTING, *warehouse.COUNTS, "plus_minus"]


def frame(spark, rows, text=(), number=()):
    """A frame of dictionaries; all named columns exist, missing values are null."""
    kinds = [StructField(n, StringType()) for n in text] + [StructField(n, LongType() if n.endswith("_id") or n in ("gp", "wins", "losses", "games") else DoubleType()) for n in number]
    conv = lambda f, v: v if v is None or f.dataType == StringType() else int(v) if f.dataType == LongType() else float(v)
    return spark.createDataFrame([tuple(conv(f, r.get(f.name)) for f in kinds) for r in rows], StructType(kinds))


def box():
    out = []
    for g, _, _, _, home, away in GAMES:
        for p, t in PLAYERS.items():
            if t in (home, away):
                r = random.Random(f"{g}{p}")
                row = {"game_id": g, "player_id": p, "team_id": t} | {x: r.randrange(1, 12) for x in STATS}
                row["min"] = "bad" if (g, p) == ("g1", 11) else str(row["min"])
                out.append(row)
    return [*out, {"game_id": "g0", "player_id": None, "team_id": GAMES[0][4], "pts": 99}]


@pytest.fixture(scope="module")
def frames(spark):
    log = [{"game_id": g, "game_date": d, "season_year": s, "season_type": k, "home_team_id": h, "visitor_team_id": a, "matchup": f"{h} vs {a}", "wl_home": "WL"[i % 2], "pts_home": 100 + i, "pts_away": 90 + i, "arena_name": f"A{h}", "arena_city": "C"} for i, (g, d, s, k, h, a) in enumerate(GAMES)]
    line = [{"game_id": g, "team_id": h, "team_id_home": h, "team_id_away": a, "pts_qtr1_home": 20, "pts_ot1_home": None, "pts_qtr1_away": 18} for g, _, _, _, h, a in GAMES]
    info = [(11, "Ann", 1, "G", "5", "2021"), (11, "Ann", 1, "G", "5", "2022"), (11, "Ann B", 2, "G", "5", "2023"), (12, "Bo", 1, None, "7", "2021"), (12, "Bo", 1, None, "7", "2022"), (21, "Cy", None, "C", "9", "2022"), (21, "Cy", None, "C", "9", "2023")]
    info = [dict(zip(("player_id", "full_name", "team_id", "position", "jersey_number", "season"), r)) | {"roster_status": "Active", "from_year": "2019", "to_year": "x"} for r in info]
    adv = [{"game_id": r["game_id"], "player_id": r["player_id"], "team_id": r["team_id"], "min": 1, **{x: k + n for n, x in enumerate(warehouse.ADVANCED)}} for k, r in enumerate(box()) if k % 3]
    shots = [{"game_id": GAMES[k % 14][0], "player_id": 11 + k % 2, "team_id": 1, "shot_zone_basic": "abc"[k % 3], "shot_zone_area": "L", "shot_zone_range": "8", "shot_made_flag": k % 2, "shot_distance": k} for k in range(30)]
    f = lambda rows, text="", number="": frame(spark, rows, text.split(), number.split())
    zone = "shot_zone_basic shot_zone_area shot_zone_range"
    staged = {
        "stg_league_game_log": f(log, "game_id game_date season_year season_type matchup wl_home arena_name arena_city", "home_team_id visitor_team_id pts_home pts_away plus_minus_home plus_minus_away"),
        "stg_schedule": f([{"game_id": g[0], "arena_name": f"A{g[4]}", "arena_city": "C"} for g in GAMES[:5]] + [{"game_id": "x", "arena_name": "Z", "arena_city": None}], "game_id arena_name arena_city"),
        "stg_arena_info": f([{"arena_name": "A1", "arena_city": "C", "arena_state": "S"}] * 2, "arena_name arena_city arena_state arena_country arena_timezone"),
        "stg_line_score": f(line, "game_id", "team_id team_id_home team_id_away pts_qtr1 pts_qtr2 pts_qtr3 pts_qtr4 " + " ".join(warehouse.LINE)),
        "stg_box_score_traditional": f(box(), "game_id start_position comment min", "player_id team_id " + " ".join(STATS[1:])),
        "stg_box_score_advanced": f(adv, "game_id", "player_id team_id min " + " ".join(warehouse.ADVANCED)),
        "stg_player_info": f(info, "full_name first_name last_name roster_status position jersey_number height weight birth_date country draft_year draft_round draft_number college_id from_year to_year season", "player_id team_id").withColumn("x", F.lit(0)),
        "stg_static_teams": spark.createDataFrame([(t, f"T{t}", f"Team {t}", "c", "s", 1950) for t in TEAMS], "id long, abbreviation string, full_name string, city string, state string, year_founded int"),
        "stg_team_details": f([{"team_id": 1, "arena": "A1"}, {"team_id": 1, "arena": "A0"}], "arena", "team_id"),
        "stg_team_info_common": f([{"team_id": 1, "team_city": "X", "team_name": "N", "team_abbreviation": "XN", "season_year": s, "team_conference": "East", "team_division": "D"} for s in ("2021", "2022")] + [{"team_id": 1, "team_city": "Y", "team_name": "N", "team_abbreviation": "YN", "season_year": "2023"}], "team_city team_name team_abbreviation season_year team_conference team_division", "team_id"),
        "stg_franchise": f([{"team_id": 1, "team_name": "F", "league_id": "00", "games": 10, "wins": 4, "start_year": 1950, "end_year": 2023}], "team_name league_id", "team_id games wins start_year end_year").withColumn("league_id", F.lit("00")),
        "stg_play_by_play": spark.createDataFrame([("g0", 1, 1, 11, 1, None, None, 31, 3), ("g0", 2, 99, None, None, 12, 1, None, None)], "game_id string, event_num int, event_msg_type int, player1_id long, player1_team_id long, player2_id long, player2_team_id long, player3_id long, player3_team_id long").withColumns({x: F.lit(None).cast("string") for x in "event_msg_action_type period wc_time_string pc_time_string home_description neutral_description visitor_description score score_margin".split()}),
        "stg_shot_chart": f(shots, f"game_id action_type shot_type {zone}", "player_id team_id period minutes_remaining seconds_remaining shot_distance loc_x loc_y shot_made_flag"),
        "stg_standings": f([{"team_id": 1, "season_year": "2023-24", "wins": 3, "losses": 4, "conference": "East"}], "season_year season_type conference division home_record road_record last_ten streak", "team_id wins losses win_pct conference_rank division_rank"),
        "stg_on_off": f([{"player_id": 11, "team_id": 1, "season_year": "2023-24", "season_type": "Regular Season", "on_off": s, "net_rating": n} for s, n in (("On", 5), ("Off", 2))], "season_year season_type on_off", "player_id team_id " + " ".join(warehouse.ON_OFF)),
        "stg_lineup": f([{"group_id": "11-12-x", "team_id": 1, "season_year": "2023-24"}] * 2, "group_id season_year", "team_id"),
        "fact_lineup_stats": f([{"group_id": "11-12", "team_id": 1, "season_year": "2023-24", "gp": 2, "min": 10, "pts": 30, "plus_minus": 1, "net_rating": 4}] * 2, "group_id season_year", "team_id gp min pts plus_minus net_rating"),
    }
    staged["stg_team_dashboard_on_off"] = staged["stg_on_off"].limit(0)
    staged["stg_player_on_details"] = staged["stg_on_off"].limit(0)
    staged["stg_team_lineups"] = staged["stg_lineup"].limit(0)
    staged["stg_team_years"] = spark.createDataFrame([(1, 1950)], "team_id long, min_year int")
    out, report = run_models(warehouse.composed(), staged)
    return out, report


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_models_build(frames):
    _, report = frames
    assert not [n for n, s in report.status.items() if s == "failed"], report.errors
    assert sum(s == "ok" for s in report.status.values()) >= 35
    assert len({m.name for m in warehouse.composed()}) == len(warehouse.composed()) > 55


def test_game_and_bridges(frames):
    f, _ = frames
    assert f["dim_game"].count() == 14 and rows(f["dim_game"].filter("game_id = 'g2'"), "arena_name") == [(f"A{GAMES[2][4]}",)]
    assert rows(f["dim_season"], "season_year", "start_date", "end_date") == [("2023-24", "2024-01-10", "2024-01-23")]
    want = sorted(x for i, g in enumerate(GAMES) for x in ((g[0], g[4], "home", "WL"[i % 2]), (g[0], g[5], "away", "LW"[i % 2])))
    assert rows(f["bridge_game_team"], "game_id", "team_id", "side", "wl") == want
    assert rows(f["bridge_play_player"], "event_num", "slot", "player_id") == [(1, 1, 11), (1, 3, 31), (2, 2, 12)]
    assert rows(f["fact_play_by_play"], "event_num", "event_type_name") == [(1, "made_shot"), (2, "unknown")]
    assert rows(f["bridge_lineup_player"].filter("player_id is not null"), "player_id", "position_in_lineup") == [(11, 1), (12, 2)]
    assert f["dim_arena"].filter("arena_name = 'A1'").count() == 1
    assert rows(f["fact_game_scoring"].filter("game_id = 'g0'"), "side", "period", "pts") == [("away", 1, 18.0), ("home", 1, 20.0)]


def test_histories(frames):
    f, _ = frames
    got = rows(f["dim_player"].withColumn("team_id", F.coalesce("team_id", F.lit(0))), "player_sk", "player_id", "team_id", "valid_from", F.coalesce("valid_to", F.lit("-")), "is_current")
    assert got == [(1, 11, 1, "2021", "2023", False), (2, 11, 2, "2023", "-", True), (3, 12, 1, "2021", "-", True), (4, 21, 0, "2022", "2023", False), (5, 21, 0, "2023", "-", True)]
    assert rows(f["dim_player"].filter("is_active and from_year = 2019 and to_year is null"), "player_sk")[-1] == (5,)
    assert rows(f["dim_team_history"], "team_history_sk", "city", "valid_from", "is_current", "franchise_name") == [(1, "X", "2021", False, "F"), (2, "Y", "2023", True, "F")]
    assert rows(f["dim_team"], "team_id", F.coalesce("arena", F.lit("-"))) == [(1, "A1"), (2, "-"), (3, "-")]


def season():
    out = {}
    kind = {g[0]: g[3] for g in GAMES}
    for r in box():
        if r["player_id"]:
            out.setdefault((r["player_id"], r["team_id"], kind[r["game_id"]]), []).append(r)
    return out


def test_seasons_and_careers(frames):
    f, _ = frames
    got = {(r.player_id, r.team_id, r.season_type): r for r in f["agg_player_season"].collect()}
    want = season()
    assert set(got) == set(want)
    for k, rs in want.items():
        g = got[k]
        mins = [float(r["min"]) for r in rs if r["min"] != "bad"]
        assert g.gp == len(rs) and g.total_pts == sum(r["pts"] for r in rs) and abs(g.avg_min - sum(mins) / len(mins)) < 1e-9
        assert abs(g.fg_pct - sum(r["fgm"] for r in rs) / sum(r["fga"] for r in rs)) < 1e-9 and g.team_abbreviation == f"T{k[1]}"
    per = {(r.player_id, r.season_type): r for r in f["agg_player_season_per36"].collect()}
    g = got[12, 1, "Regular Season"]
    assert abs(per[12, "Regular Season"].ast_per36 - g.avg_ast * 36 / g.avg_min) < 1e-9
    career = {r.player_id: r for r in f["agg_player_career"].collect()}
    for p, t in PLAYERS.items():
        rs = want.get((p, t, "Regular Season"), [])
        assert career[p].career_pts == sum(r["pts"] for r in rs) and abs(career[p].career_ppg - sum(r["pts"] for r in rs) / len(rs)) < 1e-9 and career[p].seasons_played == 1
    roll = {(r.player_id, r.game_id): r.pts_roll5 for r in f["agg_player_rolling"].collect()}
    mine = [r for r in box() if r["player_id"] == 21]
    for i, r in enumerate(mine):
        last = [x["pts"] for x in mine[max(0, i - 4) : i + 1]]
        assert abs(roll[21, r["game_id"]] - sum(last) / len(last)) < 1e-9
    assert all(r.gp >= 10 for r in f["agg_league_leaders"].collect())


def test_teams(frames):
    f, _ = frames
    pts = {}
    for r in box():
        if r["player_id"]:
            pts[r["game_id"], r["team_id"]] = pts.get((r["game_id"], r["team_id"]), 0) + r["pts"]
    assert {(r.game_id, r.team_id): r.pts for r in f["fact_team_game"].collect()} == pts
    tot = {r.game_id: r for r in f["agg_game_totals"].collect()}
    h2h = {}
    for g, _, _, _, home, away in GAMES:
        assert (tot[g].home_pts, tot[g].away_pts, tot[g].total_pts) == (pts[g, home], pts[g, away], pts[g, home] + pts[g, away])
        for a, b in ((home, away), (away, home)):
            h2h.setdefault((a, b), []).append(pts[g, a] - pts[g, b])
    got = {(r.team_id, r.opponent_team_id): r for r in f["analytics_head_to_head"].collect()}
    assert set(got) == set(h2h)
    for k, d in h2h.items():
        assert (got[k].games_played, got[k].wins, got[k].losses) == (len(d), sum(x > 0 for x in d), sum(x <= 0 for x in d)) and abs(got[k].avg_margin - sum(d) / len(d)) < 1e-9
        assert got[k].team_abbr == f"T{k[0]}" and got[k].opponent_abbr == f"T{k[1]}"
    s = {(r.team_id, r.season_type): r for r in f["analytics_team_season_summary"].collect()}
    assert s[1, "Regular Season"].wins == 3 and s[2, "Regular Season"].wins is None and s[1, "Regular Season"].team_name == "Team 1"
    assert rows(f["agg_lineup_efficiency"], "total_gp", "pts_per48") == [(4, 60 / 20 * 48)]
    assert rows(f["agg_team_franchise"], "franchise_age_years", "computed_win_pct") == [(74.0, 0.4)]


def test_wide_tables_keep_the_grain(frames):
    f, _ = frames
    n = f["agg_player_season"].count()
    for name in ("analytics_player_season_complete", "analytics_player_impact"):
        assert f[name].count() == n
    impact = f["analytics_player_impact"].filter("player_id = 11 and season_type = 'Regular Season'").collect()[0]
    assert impact.net_rating_diff == 3.0 and impact.player_name == "Ann B" and impact.team_abbreviation == "T1"
    zones = {}
    for k in range(30):
        zones.setdefault((11 + k % 2, "abc"[k % 3]), []).append(k % 2)
    assert rows(f["agg_shot_zones"], "player_id", "shot_zone_basic", "attempts", "makes") == sorted((*z, len(x), float(sum(x))) for z, x in zones.items())
    assert f["analytics_game_summary"].count() == 14


def test_order_lines_are_dealt_once(spark):
    """The first lines and their games need one exchange of the lines by order, not two."""
    from tipoff.plans import catalogue, composed_queries

    box = composed_queries.staging(catalogue.Tables(spark, "/root/testdata/sf0.001"))["stg_box_score_traditional"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for large tables
    try:
        plan = box._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("hashpartitioning(l_orderkey#") == 1
