"""Composed models of the star schema on stand-in staging tables, run in dependency order, each beside plain SQL.

Orders are games of the first five nations, suppliers are players: an order's first line of a supplier is the player's line of the box score and a shot.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from tipoff.operators import windows as W
from tipoff.plans import warehouse
from tipoff.plans.catalogue import query, rounded
from tipoff.plans.models import run_models

c = F.col
SIX = ("min", "pts", "reb", "ast", "stl", "blk", "tov")
RATED = ("off_rating", "def_rating", "net_rating", "ts_pct", "usg_pct", "pie")
SHARES = {"fg_pct": ("fgm", "fga"), "fg3_pct": ("fg3m", "fg3a"), "ft_pct": ("ftm", "fta")}
#: Box score columns as expressions that both engines read alike.
BOX = {
    "min": "l_quantity", "fgm": "floor(l_quantity / 3)", "fga": "l_quantity", "fg3m": "floor(l_quantity / 9)", "fg3a": "floor(l_quantity / 4)", "ftm": "floor(l_discount * 100 + 0.5)", "fta": "floor(l_discount * 100 + 0.5) + l_linenumber",
    "oreb": "l_linenumber % 2", "dreb": "floor(l_tax * 100 + 0.5)", "reb": "l_linenumber % 2 + floor(l_tax * 100 + 0.5)", "ast": "l_linenumber", "stl": "l_linenumber % 3", "blk": "l_partkey % 2", "tov": "l_partkey % 4", "pf": "l_partkey % 5", "pts": "floor(l_extendedprice / 1000)",
}
FIRST = ("l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
QUARTERS = ("qtr1", "qtr2", "qtr3", "qtr4", "ot1", "ot2")


def staging(t) -> dict:
    g = t.orders.join(t.customer, c("o_custkey") == c("c_custkey"))
    g = g.select(
        F.concat(F.lit("G"), c("o_orderkey").cast("string")).alias("game_id"), c("o_orderdate").cast("date").alias("game_date"), F.year("o_orderdate").cast("string").alias("season_year"),
        F.when(c("o_orderpriority") == "1-URGENT", "Playoffs").otherwise("Regular Season").alias("season_type"), (c("c_nationkey") % 5).cast("long").alias("home_team_id"), ((c("c_nationkey") % 5 + 1 + c("o_orderkey") % 4) % 5).alias("visitor_team_id"),
        F.when(c("o_orderstatus") == "F", "W").otherwise("L").alias("wl_home"), F.floor(c("o_totalprice") / 5000).alias("pts_home"), (c("o_orderkey") % 120).alias("pts_away"), "o_orderkey",
    )
    log = g.withColumn("matchup", F.concat_ws(" vs ", c("home_team_id").cast("string"), c("visitor_team_id").cast("string"))).withColumn("plus_minus_home", (c("pts_home") - c("pts_away")).cast("double")).withColumn("plus_minus_away", -c("plus_minus_home"))
    log = log.withColumn("arena_name", F.concat(F.lit("A"), c("home_team_id").cast("string"))).withColumn("arena_city", F.lit("C"))
    # dealt by order once, for the first lines and for the join
    first = W.first_of(t.lineitem.repartition("l_orderkey"), ["l_orderkey", "l_suppkey"], *(c(x) for x in FIRST))
    line = first.join(log.select("game_id", "o_orderkey", "home_team_id", "visitor_team_id"), c("l_orderkey") == c("o_orderkey"))
    line = line.withColumn("player_id", c("l_suppkey")).withColumn("team_id", F.when(c("l_linenumber") % 2 == 1, c("home_team_id")).otherwise(c("visitor_team_id")))
    box = line.select("game_id", "player_id", "team_id", F.lit(None).cast("string").alias("start_position"), F.lit(None).cast("string").alias("comment"), *(F.expr(x).cast("double").alias(n) for n, x in BOX.items()), *(F.lit(None).cast("double").alias(p) for p in SHARES), F.lit(0.0).alias("plus_minus"))
    rated = line.filter("l_returnflag <> 'A'").select("game_id", "player_id", "team_id", c("l_quantity").alias("min"), *((c("l_quantity") * (k + 1)).alias(n) for k, n in enumerate(warehouse.ADVANCED)))
    shots = line.select("game_id", "player_id", "team_id", c("l_returnflag").alias("shot_zone_basic"), c("l_linestatus").alias("shot_zone_area"), F.lit("any").alias("shot_zone_range"), c("l_quantity").alias("shot_distance"), (c("l_partkey") % 2).alias("shot_made_flag"), *(F.lit(None).cast("string").alias(x) for x in "period minutes_remaining seconds_remaining action_type shot_type loc_x loc_y".split()))
    score = log.select("game_id", c("home_team_id").alias("team_id"), c("home_team_id").alias("team_id_home"), c("visitor_team_id").alias("team_id_away"), *(F.when(F.lit(k < 5) | (c("o_orderkey") % 7 == 0), (c(f"pts_{s}") + k) % 40).alias(f"pts_{p}_{s}") for s in ("home", "away") for k, p in enumerate(QUARTERS)), *((c("pts_home") + k).alias(f"pts_{p}") for k, p in enumerate(QUARTERS[:4])))
    teams = t.nation.select(c("n_nationkey").cast("long").alias("id"), F.substring("n_name", 1, 3).alias("abbreviation"), c("n_name").alias("full_name"), F.lit("c").alias("city"), F.lit("s").alias("state"), F.lit(1950).alias("year_founded"))
    details = t.nation.filter("n_nationkey % 2 = 0").select(c("n_nationkey").cast("long").alias("team_id"), F.concat(F.lit("A"), c("n_nationkey").cast("string")).alias("arena"))
    info = t.nation.join(t.region, c("n_regionkey") == c("r_regionkey")).select(c("n_nationkey").cast("long").alias("team_id"), c("r_name").alias("team_conference"), F.lit("D").alias("team_division"))
    return {
        "stg_league_game_log": log, "stg_schedule": log.select("game_id", "arena_name", "arena_city"), "stg_box_score_traditional": box, "stg_box_score_advanced": rated, "stg_shot_chart": shots, "stg_line_score": score,
        "stg_static_teams": teams, "stg_team_details": details, "stg_team_info_common": info,
    }


def _div(a: str, b: str) -> str:
    return f"{a} / nullif({b}, 0)"


BASE = f"""
lg AS (SELECT 'G' || o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS game_date, CAST(year(o_orderdate) AS VARCHAR) AS season_year, CASE WHEN o_orderpriority = '1-URGENT' THEN 'Playoffs' ELSE 'Regular Season' END AS season_type, c_nationkey % 5 AS home, (c_nationkey % 5 + 1 + o_orderkey % 4) % 5 AS away,
  CASE WHEN o_orderstatus = 'F' THEN 'W' ELSE 'L' END AS wl, floor(o_totalprice / 5000) AS ph, o_orderkey % 120 AS pa, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey),
li AS (SELECT lg.*, l_suppkey AS player_id, CASE WHEN l_linenumber % 2 = 1 THEN home ELSE away END AS team_id, l.* FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY {', '.join(FIRST)}) = 1) l JOIN lg ON l_orderkey = o_orderkey),
bx AS (SELECT game_id, game_date, season_year, season_type, home, away, player_id, team_id, l_returnflag AS flag, {', '.join(f'CAST({x} AS DOUBLE) AS {n}' for n, x in BOX.items())} FROM li),
tg AS (SELECT game_id, season_year, season_type, game_date, home, away, team_id, {', '.join(f'sum({x}) AS {x}' for x in BOX if x != 'min')} FROM bx GROUP BY 1, 2, 3, 4, 5, 6, 7),
ps AS (SELECT player_id, team_id, season_year, season_type, count(*) AS gp, {', '.join(f'sum({x}) AS total_{x}, avg({x}) AS avg_{x}' for x in SIX)}, {', '.join(f'sum({x}) AS total_{x}' for m in SHARES.values() for x in m)}, {', '.join(f'{_div(f"sum({m})", f"sum({a})")} AS {p}' for p, (m, a) in SHARES.items())},
  {', '.join(f"avg({warehouse.ADVANCED.index(x) + 1} * CASE WHEN flag <> 'A' THEN min END) AS avg_{x}" for x in RATED)} FROM bx GROUP BY 1, 2, 3, 4),
ts AS (SELECT team_id, season_year, season_type, count(*) AS gp, {', '.join(f'avg({x}) AS avg_{x}' for x in SIX[1:])}, {', '.join(f'{_div(f"sum({m})", f"sum({a})")} AS {p}' for p, (m, a) in SHARES.items())} FROM tg GROUP BY 1, 2, 3)
"""


def six(select: str, doubles: str) -> str:
    """The columns, and the doubles rounded to six places."""
    return f"{select}, " + ", ".join(f"round({x}, 6) AS {x}" for x in doubles.split())


def _made(names: str) -> str:
    return " ".join(f"total_{x}" for x in names.split())


STATS = " ".join([*(f"total_{x} avg_{x}" for x in SIX), _made("fgm fga fg3m fg3a ftm fta"), *SHARES, *(f"avg_{x}" for x in RATED)])
SQL = {
    "dim_season": "SELECT season_year, min(game_date) AS start_date, max(game_date) AS end_date FROM lg GROUP BY 1",
    "dim_game": "SELECT game_id, game_date, season_year, season_type, home AS home_team_id, away AS visitor_team_id, home || ' vs ' || away AS matchup, 'A' || home AS arena_name, 'C' AS arena_city FROM lg",
    "dim_team": "SELECT n_nationkey AS team_id, substr(n_name, 1, 3) AS abbreviation, n_name AS full_name, 'c' AS city, 's' AS state, CASE WHEN n_nationkey % 2 = 0 THEN 'A' || n_nationkey END AS arena, 1950 AS year_founded, r_name AS conference, 'D' AS division FROM nation JOIN region ON n_regionkey = r_regionkey",
    "bridge_game_team": "SELECT game_id, home AS team_id, 'home' AS side, wl, season_year FROM lg UNION SELECT game_id, away, 'away', CASE wl WHEN 'W' THEN 'L' ELSE 'W' END, season_year FROM lg",
    "fact_team_game": f"SELECT tg.game_id, tg.team_id, tg.season_year, {', '.join(f'tg.{x}' for x in BOX if x != 'min')}, {', '.join(f'round({_div(m, a)}, 6) AS {p}' for p, (m, a) in SHARES.items())}, {', '.join(f'CASE WHEN tg.team_id = tg.home THEN CAST(ph + {k} AS BIGINT) END AS pts_{p}' for k, p in enumerate(QUARTERS[:4]))} FROM tg JOIN lg USING (game_id)",
    "fact_game_scoring": " UNION ALL ".join(f"SELECT game_id, {s} AS team_id, '{s}' AS side, {k + 1} AS period, CAST((p{s[0]} + {k}) % 40 AS BIGINT) AS pts FROM lg" + ("" if k < 5 else " WHERE o_orderkey % 7 = 0") for s in ("home", "away") for k in range(6)),
    "agg_player_season": "SELECT " + six("player_id, team_id, season_year, season_type, gp, substr(n_name, 1, 3) AS team_abbreviation", STATS) + " FROM ps JOIN nation ON team_id = n_nationkey",
    "agg_player_season_per36": "SELECT player_id, team_id, season_year, season_type, gp, round(avg_min, 6) AS avg_min, " + ", ".join(f"round({_div(f'avg_{x} * 36', 'avg_min')}, 6) AS {x}_per36" for x in SIX[1:]) + " FROM ps",
    "agg_player_career": "SELECT player_id, CAST(sum(gp) AS BIGINT) AS career_gp, sum(total_min) AS career_min, sum(total_pts) AS career_pts, " + ", ".join(f"round({_div(f'sum(total_{x})', 'sum(gp)')}, 6) AS career_{n}" for x, n in (("pts", "ppg"), ("reb", "rpg"), ("ast", "apg"), ("stl", "spg"), ("blk", "bpg"))) + ", " + ", ".join(f"round({_div(f'sum(total_{m})', f'sum(total_{a})')}, 6) AS career_{p}" for p, (m, a) in SHARES.items()) + ", min(season_year) AS first_season, max(season_year) AS last_season, count(DISTINCT season_year) AS seasons_played FROM ps WHERE season_type = 'Regular Season' GROUP BY 1",
    "agg_player_rolling": "SELECT game_id, player_id, season_year, game_date, " + ", ".join(f"round(avg({x}) OVER (PARTITION BY player_id, season_year ORDER BY game_date, game_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW), 6) AS {x}_roll{n}" for n in (5, 10, 20) for x in ("pts", "reb", "ast")) + " FROM bx",
    "agg_league_leaders": "SELECT player_id, season_year, season_type, gp, " + ", ".join(f"round({x}, 6) AS {x}" for x in (*(f"avg_{y}" for y in ("pts", "reb", "ast", "stl", "blk")), *SHARES)) + ", " + ", ".join(f"CAST(rank() OVER (PARTITION BY season_year, season_type ORDER BY avg_{y} DESC NULLS LAST) AS INTEGER) AS {y}_rank" for y in ("pts", "reb", "ast", "stl", "blk")) + " FROM ps WHERE gp >= 10",
    "agg_team_season": "SELECT " + six("team_id, season_year, season_type, gp", " ".join([*(f"avg_{x}" for x in SIX[1:]), *SHARES])) + " FROM ts",
    "agg_shot_zones": "SELECT player_id, season_year, l_returnflag AS shot_zone_basic, l_linestatus AS shot_zone_area, 'any' AS shot_zone_range, count(*) AS attempts, CAST(sum(l_partkey % 2) AS BIGINT) AS makes, round(sum(l_partkey % 2) / count(*), 6) AS fg_pct, round(avg(l_quantity), 6) AS avg_distance FROM li GROUP BY 1, 2, 3, 4",
    "agg_game_totals": "SELECT h.game_id, h.game_date, h.season_year, h.season_type, " + ", ".join(f"{t}.team_id AS {s}_team_id, {t}.pts AS {s}_pts, {t}.reb AS {s}_reb, {t}.ast AS {s}_ast, round({_div(f'{t}.fgm', f'{t}.fga')}, 6) AS {s}_fg_pct" for t, s in (("h", "home"), ("a", "away"))) + ", h.pts + a.pts AS total_pts FROM tg h JOIN tg a ON h.game_id = a.game_id AND h.team_id = h.home AND a.team_id = a.away",
    "analytics_head_to_head": "SELECT x.team_id, y.team_id AS opponent_team_id, x.season_year, count(*) AS games_played, count(*) FILTER (WHERE x.pts > y.pts) AS wins, count(*) FILTER (WHERE NOT x.pts > y.pts) AS losses, round(avg(x.pts), 6) AS avg_pts_scored, round(avg(y.pts), 6) AS avg_pts_allowed, round(avg(x.pts - y.pts), 6) AS avg_margin, max(substr(m.n_name, 1, 3)) AS team_abbr, max(substr(n.n_name, 1, 3)) AS opponent_abbr FROM tg x JOIN tg y ON x.game_id = y.game_id AND x.team_id <> y.team_id JOIN nation m ON m.n_nationkey = x.team_id JOIN nation n ON n.n_nationkey = y.team_id GROUP BY 1, 2, 3",
    "analytics_league_benchmarks": "SELECT * FROM (SELECT season_year, season_type, count(DISTINCT player_id) AS total_players, " + ", ".join(f"round(avg({v}), 6) AS league_avg_{n}" for n, v in {"ppg": "avg_pts", "rpg": "avg_reb", "apg": "avg_ast", "spg": "avg_stl", "bpg": "avg_blk", **{p: p for p in SHARES}, "ts_pct": "avg_ts_pct", "usg_pct": "avg_usg_pct"}.items()) + " FROM ps WHERE gp >= 10 GROUP BY 1, 2) LEFT JOIN (SELECT season_year, season_type, count(DISTINCT team_id) AS total_teams, " + ", ".join(f"round(avg({v}), 6) AS league_avg_team_{n}" for n, v in {"ppg": "avg_pts", "rpg": "avg_reb", "apg": "avg_ast", "fg_pct": "fg_pct", "fg3_pct": "fg3_pct"}.items()) + " FROM ts GROUP BY 1, 2) USING (season_year, season_type)",
}


def needed(name: str) -> list:
    """The models that a model needs, itself included."""
    by = {m.name: m for m in warehouse.composed()}
    wanted, todo = set(), [name]
    while todo:
        n = todo.pop()
        if n in by and n not in wanted:
            wanted.add(n)
            todo += by[n].inputs
    return [by[n] for n in wanted]


def _run(name: str, t):
    frames, report = run_models(needed(name), staging(t))
    if report.errors:
        raise RuntimeError(report.errors)
    return rounded(frames[name], 6)


for _name, _sql in SQL.items():
    query(f"mdl_{_name}", f"WITH {BASE} {_sql}")(partial(_run, _name))
