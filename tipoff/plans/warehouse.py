"""The composed models of the star schema: dimensions, bridges, facts, season and career aggregates, wide tables.

Each is a lazy frame over the frames it names, built from the operators; run_models puts them in order. Ratios are doubles, null
for a zero denominator. A key that is found twice in a lookup table is looked up once, so a fact's grain stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tipoff.functions.scalars import EVENT_NAMES, code_name, ratio, text_key
from tipoff.operators import reshape as R
from tipoff.operators import windows as W
from tipoff.plans.models import Model
from tipoff.sources.generators import calendar

c = F.col
Frames = dict[str, DataFrame]
_MODELS: list[Model] = []

#: Columns by meaning, in the order of the outputs.
SHOOTING = "fgm fga fg_pct fg3m fg3a fg3_pct ftm fta ft_pct".split()
COUNTS = "oreb dreb reb ast stl blk tov pf pts".split()
LINE = [f"pts_{p}_{side}" for side in ("home", "away") for p in ("qtr1", "qtr2", "qtr3", "qtr4", "ot1", "ot2")]
ADVANCED = """off_rating def_rating net_rating ast_pct ast_tov ast_ratio oreb_pct dreb_pct reb_pct tov_pct efg_pct ts_pct usg_pct pace poss
pie e_off_rating e_def_rating e_net_rating e_usg_pct e_pace""".split()
HUSTLE = "contested_shots contested_shots_2pt contested_shots_3pt deflections charges_drawn screen_assists screen_ast_pts loose_balls_recovered box_outs".split()
SCORING = """pct_fga_2pt pct_fga_3pt pct_pts_2pt pct_pts_2pt_mr pct_pts_3pt pct_pts_fb pct_pts_ft pct_pts_off_tov pct_pts_paint pct_ast_2pm
pct_uast_2pm pct_ast_3pm pct_uast_3pm pct_ast_fgm pct_uast_fgm""".split()
USAGE = "usg_pct pct_fgm pct_fga pct_fg3m pct_fg3a pct_ftm pct_fta pct_oreb pct_dreb pct_reb pct_ast pct_tov pct_stl pct_blk pct_pts".split()
MISC = {"pts_off_tov": "pts_off_tov", "second_chance_pts": "pts_2nd_chance", "fbps": "pts_fb", "pitp": "pts_paint"}
TRACKED = "spd dist orbc drbc rbc tchs sast ftast".split()
CONTESTED = "cfgm cfga cfg_pct ufgm ufga ufg_pct dfgm dfga dfg_pct".split()
COMBINE = """height_wo_shoes height_w_shoes weight wingspan standing_reach body_fat_pct hand_length hand_width standing_vertical_leap
max_vertical_leap lane_agility_time three_quarter_sprint bench_press""".split()
ON_OFF = "gp min pts reb ast off_rating def_rating net_rating".split()
PLAY_NAMES = EVENT_NAMES | {1: "made_shot", 2: "missed_shot"}


def model(name: str, *inputs: str) -> Callable:
    """Register a function of the input frames, in their order."""

    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        _MODELS.append(Model(name, list(inputs), lambda frames: f(*(frames[i] for i in inputs))))
        return f

    return add


def composed() -> list[Model]:
    return list(_MODELS)


def one_each(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row of each key: the first in order; where the order is open, by the rest of the columns, so that reruns agree."""
    rest = [c(x) for x in df.columns if x not in keys]
    if not order and rest:  # the largest row, nulls last: combined before the shuffle
        return df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row")).select(*keys, "_row.*").select(*df.columns)
    return W.first_of(df, keys, *order, *(x.desc_nulls_last() for x in rest))


def look_up(fact: DataFrame, dim: DataFrame, on: dict[str, str], columns: dict[str, str]) -> DataFrame:
    """The fact with columns (new name: the dimension's name) of the row that matches on (fact's column: dimension's column)."""
    d = dim.select(*(c(k).alias(f"_k_{k}") for k in on.values()), *(c(v).alias(f"_v_{n}") for n, v in columns.items()))
    d = one_each(d, [f"_k_{k}" for k in on.values()])
    hit = [c(f) == c(f"_k_{k}") for f, k in on.items()]
    cond = hit[0]
    for h in hit[1:]:
        cond = cond & h
    out = fact.join(d, cond, "left")
    kept = [x for x in fact.columns if x not in columns]
    return out.select(*kept, *(c(f"_v_{n}").alias(n) for n in columns))


def current(players: DataFrame) -> DataFrame:
    return players.filter("is_current")


def with_names(df: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """player_name of the current record and team_abbreviation."""
    return look_up(look_up(df, current(players), {"player_id": "player_id"}, {"player_name": "full_name"}), teams, {"team_id": "team_id"}, {"team_abbreviation": "abbreviation"})


def same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def shares() -> list[Column]:
    """Shooting percentages as ratios of sums."""
    return [ratio(F.sum(m), F.sum(a)).alias(p) for m, a, p in (("fgm", "fga", "fg_pct"), ("fg3m", "fg3a", "fg3_pct"), ("ftm", "fta", "ft_pct"))]


# --- dimensions


@model("dim_season", "stg_league_game_log")
def _(log):
    return log.groupBy("season_year").agg(F.min("game_date").alias("start_date"), F.max("game_date").alias("end_date"))


@model("dim_game", "stg_league_game_log", "stg_schedule")
def _(log, schedule):
    games = one_each(log.select("game_id", "game_date", "season_year", "season_type", "home_team_id", "visitor_team_id", "matchup"), ["game_id"], F.desc_nulls_last("game_date"))
    return look_up(games, schedule, same("game_id"), same("arena_name", "arena_city"))


@model("dim_arena", "stg_schedule", "stg_league_game_log", "stg_arena_info")
def _(schedule, log, info):
    place = ["arena_name", "arena_city"]
    every = schedule.select(*place).unionByName(log.select(*place)).distinct()
    more = look_up(every, info, same(*place), same("arena_state", "arena_country", "arena_timezone"))
    return more.select(text_key(*map(c, place)).cast("int").alias("arena_id"), *place, "arena_state", "arena_country", "arena_timezone")


@model("dim_coach", "stg_coaches")
def _(coaches):
    one = one_each(coaches.withColumnRenamed("season", "season_year"), ["coach_id", "team_id", "season_year"], c("coach_type").asc_nulls_last())
    return one.select("coach_id", "team_id", "season_year", "first_name", "last_name", "coach_type", c("is_assistant").try_cast("boolean").alias("is_assistant"))


@model("dim_college", "stg_player_college")
def _(colleges):
    names = colleges.select("college_name").filter(c("college_name").isNotNull()).distinct()
    return names.select(text_key(c("college_name")).cast("int").alias("college_id"), "college_name")


@model("dim_official", "stg_officials")
def _(officials):
    return one_each(officials.select("official_id", "first_name", "last_name", "jersey_number"), ["official_id"])


@model("dim_shot_zone", "stg_shot_chart")
def _(shots):
    zone = ["shot_zone_basic", "shot_zone_area", "shot_zone_range"]
    return shots.select(*zone).distinct().select(text_key(*map(c, zone)).cast("int").alias("zone_id"), *zone)


@model("dim_team", "stg_static_teams", "stg_team_details", "stg_team_info_common")
def _(teams, details, info):
    base = one_each(teams.select(c("id").alias("team_id"), "abbreviation", "full_name", "city", "state", "year_founded"), ["team_id"])
    out = look_up(look_up(base, details, same("team_id"), same("arena")), info, same("team_id"), {"conference": "team_conference", "division": "team_division"})
    return out.select("team_id", "abbreviation", "full_name", "city", "state", "arena", "year_founded", "conference", "division")


@model("dim_team_extended", "stg_team_details", "stg_team_info_common", "stg_team_years")
def _(details, info, years):
    return details.join(info, "team_id").join(years, "team_id", "left")


def history(df: DataFrame, key: str, at: str, attrs: list[str], number: str) -> DataFrame:
    """A type 2 dimension with a dense number in the order of key and time: a row for each change of attrs, and after a null in the first."""
    before = {a: F.lag(a).over(W.by([key], c(at).asc_nulls_last())) for a in attrs}
    new = before[attrs[0]].isNull()
    for a, was in before.items():
        new = new | ~was.eqNullSafe(c(a))
    rows = df.withColumn("_new", new).filter("_new").drop("_new").withColumn("valid_from", c(at))
    return W.dense_key(W.validity(rows, [key], "valid_from"), [key, "valid_from"], number)


@model("dim_player", "stg_player_info")
def _(info):
    active = c("roster_status").cast("string").isin("Active", "1")
    rows = info.withColumn("is_active", F.coalesce(active, F.lit(False))).withColumns({y: c(y).cast("string").try_cast("int") for y in ("from_year", "to_year")})
    out = history(rows, "player_id", "season", ["team_id", "position", "jersey_number"], "player_sk")
    kept = """player_sk player_id full_name first_name last_name is_active position team_id jersey_number height weight birth_date country draft_year
    draft_round draft_number college_id from_year to_year valid_from valid_to is_current""".split()
    return out.select(*kept)


@model("dim_team_history", "stg_team_info_common", "stg_franchise")
def _(info, franchise):
    rows = info.select("team_id", c("team_city").alias("city"), c("team_name").alias("nickname"), c("team_abbreviation").alias("abbreviation"), "season_year")
    rows = look_up(rows, franchise, same("team_id"), {"franchise_name": "team_name", "league_id": "league_id"})
    out = history(rows, "team_id", "season_year", ["city", "nickname", "abbreviation"], "team_history_sk")
    return out.select("team_history_sk", "team_id", "city", "nickname", "abbreviation", "franchise_name", "league_id", "valid_from", "valid_to", "is_current")


@model("dim_schedule_int", "stg_schedule_int", "stg_schedule_int_weeks")
def _(games, weeks):
    out = one_each(games, ["game_id"], F.desc_nulls_last("game_status"))
    names = {"day": "day_of_week"} | {f"{side}_team_team_{x}": f"{side}_team_{x}" for side in ("home", "away") for x in ("id", "name", "city", "tricode")}
    out = out.withColumnsRenamed({a: b for a, b in names.items() if a in out.columns})
    return look_up(out, weeks, same("season_year", "week_number"), {"week_start_date": "start_date", "week_end_date": "end_date"})


@model("dim_date")
def _():
    """The days from 1946 to a year from today; a season begins in October."""
    from pyspark.sql import SparkSession

    span = SparkSession.active().range(1).select(F.lit("1946-01-01").cast("date").alias("lo"), F.date_add(F.current_date(), 365).alias("hi"))
    day, year = c("day"), F.year("day")
    start = F.when(F.month("day") >= 10, year).otherwise(year - 1)
    d = calendar(span).select("date_key", c("iso").alias("full_date"), day.alias("_day"), year.alias("year"), F.month("day").alias("month"), F.dayofmonth("day").alias("day"), c("weekday").alias("day_of_week"), "day_name", "month_name", "is_weekend", F.concat(start.cast("string"), F.lit("-"), F.lpad(((start + 1) % 100).cast("string"), 2, "0")).alias("nba_season"))
    return d.drop("_day")


# --- bridges


@model("bridge_game_team", "stg_league_game_log")
def _(log):
    lost = F.when(c("wl_home") == "W", "L").when(c("wl_home") == "L", "W")
    rows = log.withColumn("_away", lost)
    out = R.flip(rows, ["game_id", "season_year"], {"team_id": "home_team_id", "wl": "wl_home"}, {"team_id": "visitor_team_id", "wl": "_away"})
    return out.select("game_id", "team_id", "side", "wl", "season_year").distinct()


@model("bridge_play_player", "stg_play_by_play")
def _(plays):
    slot = lambda k: F.struct(F.lit(k).alias("slot"), c(f"player{k}_id").alias("player_id"), c(f"player{k}_team_id").alias("team_id"))
    return plays.select("game_id", "event_num", F.inline(F.array(*(slot(k) for k in (1, 2, 3))))).filter(c("player_id").isNotNull())


@model("bridge_lineup_player", "stg_lineup", "stg_team_lineups")
def _(a, b):
    group = ["group_id", "team_id", "season_year"]
    rows = a.select(*group).unionByName(b.select(*group)).distinct()
    out = R.split_ids(rows, group, "group_id", "-", "player_id")
    out = out.groupBy(*group, "player_id").agg(F.min("position").cast("int").alias("position_in_lineup"))
    return out.select("group_id", "player_id", "team_id", "position_in_lineup", "season_year")


@model("bridge_player_team_season", "stg_player_info")
def _(info):
    return info.filter("player_id is not null and team_id is not null").select("player_id", "team_id", c("season").alias("season_year"), "jersey_number", "position").distinct()


@model("bridge_game_official", "stg_officials")
def _(officials):
    return officials.select("game_id", "official_id").distinct()


# --- facts


@model("fact_game_context", "stg_game_summary", "stg_game_info", "stg_other_stats", "stg_inactive_players", "stg_season_series", "stg_last_meeting", "stg_game_summary_available_video")
def _(summary, info, stats, inactive, series, meeting, video):
    """A game's summary with its info and other statistics, and the rows of four further sources, by their source."""
    whole = summary
    for more in (info, stats):
        one = one_each(more, ["game_id"])
        whole = whole.join(one.select("game_id", *(x for x in one.columns if x not in whole.columns)), "game_id", "left")
    return R.tagged_union({"summary": whole, "inactive_players": inactive, "season_series": series, "last_meeting": meeting, "available_video": video}, "context_source")


@model("fact_playoff_picture", *(f"stg_playoff_picture_{side}{part}" for side in ("east", "west") for part in ("", "_standings", "_remaining")))
def _(*sides):
    """Both conferences' pictures with their standings and remaining games."""

    def side(picture, *more):
        for m in more:
            one = one_each(m, ["team_id"])
            picture = picture.join(one.select("team_id", *(x for x in one.columns if x not in picture.columns)), "team_id", "left")
        return picture

    return R.tagged_union({"East": side(*sides[:3]), "West": side(*sides[3:])}, "conference")


def in_game(rows: DataFrame, games: DataFrame, columns: list[str]) -> DataFrame:
    """Player rows with the game's season after the keys."""
    got = look_up(rows.filter(c("player_id").isNotNull()), games, same("game_id"), same("season_year"))
    return got.select("game_id", "player_id", "team_id", "season_year", *columns)


@model("fact_player_game_traditional", "stg_box_score_traditional", "dim_game")
def _(box, games):
    return in_game(box.withColumn("min", c("min").cast("string").try_cast("double")), games, ["start_position", "comment", "min", *SHOOTING, *COUNTS, "plus_minus"])


@model("fact_player_game_advanced", "stg_box_score_advanced", "dim_game")
def _(box, games):
    return in_game(box, games, ["min", *ADVANCED])


@model("fact_player_game_hustle", "stg_box_score_hustle", "dim_game")
def _(box, games):
    return in_game(box, games, ["min", *HUSTLE])


@model("fact_player_game_misc", "stg_box_score_misc", "stg_box_score_scoring", "stg_box_score_usage", "dim_game")
def _(misc, scoring, usage, games):
    own = MISC | {f"opp_{n}": f"opp_{s}" for n, s in MISC.items()}
    rows = misc.select("game_id", "player_id", "team_id", *(c(s).alias(n) for n, s in own.items()))
    key = same("game_id", "player_id")
    rows = look_up(look_up(rows, scoring, key, same(*SCORING)), usage, key, same(*USAGE))
    return in_game(rows, games, [*own, *SCORING, *USAGE])


@model("fact_player_game_tracking", "stg_box_score_player_track", "stg_box_score_defensive", "dim_game")
def _(track, defence, games):
    more = {"matchup_min": "matchup_min", "partial_poss": "partial_poss", "switches_on": "switches_on", "def_player_pts": "player_pts", "def_matchup_fgm": "def_fgm", "def_matchup_fga": "def_fga", "def_matchup_fg_pct": "def_fg_pct"}
    rows = look_up(track.withColumnRenamed("pass", "passes"), defence, same("game_id", "player_id"), more)
    return in_game(rows, games, ["min", *TRACKED, "passes", *CONTESTED, *more])


@model("fact_team_game", "stg_box_score_traditional", "stg_line_score", "dim_game")
def _(box, line, games):
    sums = [F.sum(x).alias(x) for x in (*(s for s in SHOOTING if not s.endswith("pct")), *COUNTS)]
    rows = box.filter(c("player_id").isNotNull()).groupBy("game_id", "team_id").agg(*sums, *shares())
    rows = look_up(rows, games, same("game_id"), same("season_year"))
    return look_up(rows, line, same("game_id", "team_id"), same("pts_qtr1", "pts_qtr2", "pts_qtr3", "pts_qtr4"))


@model("fact_game_result", "stg_league_game_log", "stg_line_score")
def _(log, line):
    head = "game_id game_date season_year season_type home_team_id visitor_team_id wl_home pts_home pts_away plus_minus_home plus_minus_away".split()
    one = one_each(log.select(*head), ["game_id"], F.desc_nulls_last("season_year"), F.desc_nulls_last("game_date"))
    return look_up(one, line, same("game_id"), same(*LINE))


@model("fact_game_scoring", "stg_line_score")
def _(line):
    period = lambda side: F.array(*(F.struct(F.lit(k).alias("period"), c(f"pts_{p}_{side}").alias("pts")) for k, p in enumerate(("qtr1", "qtr2", "qtr3", "qtr4", "ot1", "ot2"), 1)))
    parts = [line.select("game_id", c(f"team_id_{s}").alias("team_id"), F.lit(s).alias("side"), F.inline(period(s))) for s in ("home", "away")]
    return parts[0].unionByName(parts[1]).filter(c("pts").isNotNull())


@model("fact_play_by_play", "stg_play_by_play")
def _(plays):
    kept = """game_id event_num event_msg_type event_msg_action_type period wc_time_string pc_time_string home_description neutral_description
    visitor_description score score_margin player1_id player1_team_id player2_id player2_team_id player3_id player3_team_id""".split()
    return plays.select(*kept, code_name(c("event_msg_type"), PLAY_NAMES).alias("event_type_name"))


def latest_log(*logs: DataFrame, keys: list[str]) -> DataFrame:
    every = logs[0]
    for x in logs[1:]:
        every = every.unionByName(x, allowMissingColumns=True)
    return one_each(every, keys, F.desc_nulls_last("season_year"))


@model("fact_player_game_log", "stg_player_game_logs", "stg_player_game_log", "stg_player_game_logs_v2")
def _(a, b, d):
    return latest_log(a, b, d, keys=["player_id", "game_id"])


@model("fact_team_game_log", "stg_team_game_logs_v2", "stg_team_game_log")
def _(a, b):
    return latest_log(a, b, keys=["team_id", "game_id"])


@model("fact_rotation", "stg_rotation_away", "stg_rotation_home")
def _(away, home):
    both = R.tagged_union({"away": away, "home": home}, "side")
    return both.select("game_id", "team_id", c("person_id").alias("player_id"), "in_time_real", "out_time_real", c("player_pts").alias("pts"), c("pt_diff").alias("pts_diff"), "usg_pct", "side")


@model("fact_shot_chart", "stg_shot_chart", "dim_game")
def _(shots, games):
    kept = "period minutes_remaining seconds_remaining action_type shot_type shot_zone_basic shot_zone_area shot_zone_range shot_distance loc_x loc_y shot_made_flag".split()
    return look_up(shots, games, same("game_id"), same("season_year")).select("game_id", "player_id", "team_id", "season_year", *kept)


@model("fact_standings", "stg_standings")
def _(standings):
    kept = "conference division wins losses win_pct conference_rank division_rank home_record road_record last_ten streak".split()
    return standings.select("team_id", "season_year", F.coalesce("season_type", F.lit("Regular Season")).alias("season_type"), *kept)


@model("fact_draft", "stg_draft", "stg_draft_combine")
def _(draft, combine):
    head = "person_id player_name season round_number round_pick overall_pick draft_type team_id organization organization_type".split()
    return look_up(draft.select(*head), combine, {"person_id": "player_id", "season": "season"}, same(*COMBINE))


# --- seasons and careers


def averages(names: list[str], of: str = "") -> list[Column]:
    return [F.avg(f"{of}{n}").alias(f"avg_{n}") for n in names]


SEASON = ["season_year", "season_type"]


def in_season(fact: DataFrame, games: DataFrame) -> DataFrame:
    """Facts of known games with the game's season and type."""
    seasons = games.select("game_id", *SEASON).dropDuplicates(["game_id"])
    return fact.drop(*SEASON).join(seasons, "game_id")


@model("agg_player_season", "fact_player_game_traditional", "fact_player_game_advanced", "dim_game", "dim_team")
def _(box, advanced, games, teams):
    rated = ["off_rating", "def_rating", "net_rating", "ts_pct", "usg_pct", "pie"]
    rows = look_up(in_season(box, games), advanced, same("game_id", "player_id"), same(*rated))
    both = [f(x).alias(f"{n}_{x}") for x in ("min", "pts", "reb", "ast", "stl", "blk", "tov") for n, f in (("total", F.sum), ("avg", F.avg))]
    made = [F.sum(x).alias(f"total_{x}") for x in ("fgm", "fga", "fg3m", "fg3a", "ftm", "fta")]
    s = rows.groupBy("player_id", "team_id", *SEASON).agg(F.count(F.lit(1)).alias("gp"), *both, *made, *shares(), *averages(rated))
    return look_up(s, teams, same("team_id"), {"team_abbreviation": "abbreviation"})


@model("agg_player_season_advanced", "fact_player_game_advanced", "dim_game")
def _(advanced, games):
    rated = "off_rating def_rating net_rating ts_pct usg_pct efg_pct ast_pct ast_ratio oreb_pct dreb_pct reb_pct tov_pct pace pie".split()
    return in_season(advanced, games).groupBy("player_id", "team_id", *SEASON).agg(F.count(F.lit(1)).alias("gp"), *averages(rated))


def per_minutes(base: int) -> Callable[[DataFrame], DataFrame]:
    def build(season: DataFrame) -> DataFrame:
        per = [ratio(c(f"avg_{x}") * float(base), c("avg_min")).alias(f"{x}_per{base}") for x in ("pts", "reb", "ast", "stl", "blk", "tov")]
        return season.select("player_id", "team_id", *SEASON, "gp", "avg_min", *per)

    return build


for _base in (36, 48):
    model(f"agg_player_season_per{_base}", "agg_player_season")(per_minutes(_base))


@model("agg_player_career", "agg_player_season")
def _(season):
    per_game = [ratio(F.sum(f"total_{x}"), F.sum("gp")).alias(f"career_{n}") for x, n in (("pts", "ppg"), ("reb", "rpg"), ("ast", "apg"), ("stl", "spg"), ("blk", "bpg"))]
    made = [ratio(F.sum(f"total_{m}"), F.sum(f"total_{a}")).alias(f"career_{p}") for m, a, p in (("fgm", "fga", "fg_pct"), ("fg3m", "fg3a", "fg3_pct"), ("ftm", "fta", "ft_pct"))]
    bounds = [F.min("season_year").alias("first_season"), F.max("season_year").alias("last_season"), F.count_distinct("season_year").alias("seasons_played")]
    totals = [F.sum("gp").alias("career_gp"), F.sum("total_min").alias("career_min"), F.sum("total_pts").alias("career_pts")]
    return season.filter(c("season_type") == "Regular Season").groupBy("player_id").agg(*totals, *per_game, *made, *bounds)


@model("agg_player_rolling", "fact_player_game_traditional", "dim_game")
def _(box, games):
    g = games.select("game_id", "season_year", "game_date").dropDuplicates(["game_id"])
    rows = box.drop("season_year").join(g, "game_id")
    order = W.by(["player_id", "season_year"], c("game_date"), c("game_id"))
    form = [F.avg(x).over(order.rowsBetween(1 - n, 0)).alias(f"{x}_roll{n}") for n in (5, 10, 20) for x in ("pts", "reb", "ast")]
    return rows.select("game_id", "player_id", "season_year", "game_date", *form)


@model("agg_league_leaders", "agg_player_season")
def _(season):
    kept = "player_id season_year season_type gp avg_pts avg_reb avg_ast avg_stl avg_blk fg_pct fg3_pct ft_pct".split()
    ranks = W.leaderboard(season.filter("gp >= 10").select(*kept), SEASON, [f"avg_{x}" for x in ("pts", "reb", "ast", "stl", "blk")])
    return ranks.withColumnsRenamed({f"avg_{x}_rank": f"{x}_rank" for x in ("pts", "reb", "ast", "stl", "blk")})


@model("agg_team_season", "fact_team_game", "dim_game")
def _(team_games, games):
    return in_season(team_games, games).groupBy("team_id", *SEASON).agg(F.count(F.lit(1)).alias("gp"), *averages(["pts", "reb", "ast", "stl", "blk", "tov"]), *shares())


@model("agg_team_pace_and_efficiency", "fact_box_score_advanced_team", "dim_game")
def _(box, games):
    named = {"pace": "avg_pace", "off_rating": "avg_ortg", "def_rating": "avg_drtg", "net_rating": "avg_net_rtg"}
    return in_season(box, games).groupBy("team_id", *SEASON).agg(F.count(F.lit(1)).alias("gp"), *(F.avg(x).alias(n) for x, n in named.items()))


@model("agg_team_defense", "fact_box_score_advanced_team", "fact_team_game_hustle", "fact_box_score_four_factors_team", "dim_game")
def _(box, hustle, factors, games):
    key = same("team_id", "game_id")
    own = {"opp_efg_pct": "opp_effective_field_goal_percentage", "opp_fta_rate": "opp_free_throw_attempt_rate", "opp_tov_pct": "opp_team_turnover_percentage", "opp_oreb_pct": "opp_offensive_rebound_percentage"}
    hard = ["contested_shots", "deflections", "loose_balls_recovered", "charges_drawn", "screen_assists"]
    rows = look_up(look_up(in_season(box, games), hustle, key, same(*hard)), factors, key, own)
    return rows.groupBy("team_id", *SEASON).agg(F.count(F.lit(1)).alias("gp"), *averages(["def_rating", "net_rating", *own, *hard]))


@model("agg_team_franchise", "stg_franchise")
def _(franchise):
    pct = F.when(c("games") > 0, F.round(c("wins") / c("games"), 3))
    return franchise.select("*", (c("end_year") - c("start_year") + 1).alias("franchise_age_years"), pct.alias("computed_win_pct"))


@model("agg_lineup_efficiency", "fact_lineup_stats")
def _(lineups):
    return lineups.groupBy("group_id", "team_id", "season_year").agg(
        F.sum("gp").alias("total_gp"), F.sum("min").alias("total_min"), (ratio(F.sum("pts"), F.sum("min")) * 48).alias("pts_per48"), F.avg("net_rating").alias("avg_net_rating"), F.sum("plus_minus").alias("total_plus_minus")
    )


@model("agg_shot_zones", "fact_shot_chart", "dim_game")
def _(shots, games):
    g = games.select("game_id", "season_year").dropDuplicates(["game_id"])
    rows = shots.drop("season_year").join(g, "game_id")
    n, hit = F.count(F.lit(1)), F.sum("shot_made_flag")
    return rows.groupBy("player_id", "season_year", "shot_zone_basic", "shot_zone_area", "shot_zone_range").agg(n.alias("attempts"), hit.alias("makes"), ratio(hit, n).alias("fg_pct"), F.avg("shot_distance").alias("avg_distance"))


@model("agg_shot_location_season", "stg_shot_locations")
def _(shots):
    order = W.by(["season_year"], F.desc_nulls_last("fgm"), *(c(x).asc_nulls_last() for x in shots.columns if x not in ("season_year", "fgm")))
    return shots.withColumn("season_fgm_rank", F.row_number().over(order))


@model("agg_game_totals", "fact_team_game", "bridge_game_team", "dim_game")
def _(team_games, bridge, games):
    rows = team_games.join(bridge.select("game_id", "team_id", "side"), ["game_id", "team_id"])
    side = lambda s: rows.filter(c("side") == s).select("game_id", *(x.alias(f"{s}_{n}") for n, x in (("team_id", c("team_id")), ("pts", c("pts")), ("reb", c("reb")), ("ast", c("ast")), ("fg_pct", ratio(c("fgm"), c("fga"))))))
    out = games.select("game_id", "game_date", *SEASON).join(side("home"), "game_id").join(side("away"), "game_id")
    return out.withColumn("total_pts", c("home_pts") + c("away_pts"))


@model("agg_clutch_stats", "stg_player_dashboard_clutch", "stg_league_player_clutch")
def _(dash, league):
    key = ["player_id", "season_year"]
    d = one_each(dash, key, F.desc_nulls_last("gp")).select(*key, *(c(x).alias(f"clutch_{x}") for x in ("gp", "min", "pts", "fg_pct", "ft_pct")))
    g = one_each(league, key, F.desc_nulls_last("pts")).select(*key, *(c(x).alias(f"league_clutch_{x}") for x in ("pts", "fg_pct")))
    return d.join(g, key, "full")


@model("agg_on_off_splits", "stg_on_off", "stg_team_dashboard_on_off", "stg_player_on_details")
def _(player, team, detail):
    kept = ["team_id", *SEASON, "on_off", *ON_OFF]
    part = lambda df, key: df.select(c(key).alias("entity_id"), *kept)
    return R.tagged_union({"player": part(player, "player_id"), "team": part(team, "team_id"), "player_detail": part(detail, "player_id")}, "entity_type")


# --- wide tables


@model("analytics_head_to_head", "fact_team_game", "dim_team", "dim_game")
def _(team_games, teams, games):
    g = games.select("game_id", "season_year", "home_team_id", "visitor_team_id").dropDuplicates(["game_id"])
    rival = F.when(c("home_team_id") == c("team_id"), c("visitor_team_id")).otherwise(c("home_team_id"))
    rows = team_games.select("game_id", "team_id", "pts").join(g, "game_id").withColumn("opponent_team_id", rival)
    other = team_games.select("game_id", c("team_id").alias("opponent_team_id"), c("pts").alias("against"))
    rows = rows.join(other, ["game_id", "opponent_team_id"])
    won = F.coalesce(c("pts") > c("against"), F.lit(False))
    s = rows.groupBy("team_id", "opponent_team_id", "season_year").agg(
        F.count(F.lit(1)).alias("games_played"), F.count_if(won).alias("wins"), F.count_if(~won).alias("losses"), F.avg("pts").alias("avg_pts_scored"), F.avg("against").alias("avg_pts_allowed"), F.avg(c("pts") - c("against")).alias("avg_margin")
    )
    return look_up(look_up(s, teams, same("team_id"), {"team_abbr": "abbreviation"}), teams, {"opponent_team_id": "team_id"}, {"opponent_abbr": "abbreviation"})


@model("analytics_league_benchmarks", "agg_player_season", "agg_team_season")
def _(players, teams):
    per = {"ppg": "avg_pts", "rpg": "avg_reb", "apg": "avg_ast", "spg": "avg_stl", "bpg": "avg_blk"} | same("fg_pct", "fg3_pct", "ft_pct") | {"ts_pct": "avg_ts_pct", "usg_pct": "avg_usg_pct"}
    p = players.filter("gp >= 10").groupBy(*SEASON).agg(F.count_distinct("player_id").alias("total_players"), *(F.avg(v).alias(f"league_avg_{n}") for n, v in per.items()))
    own = {n: per[n] for n in ("ppg", "rpg", "apg", "fg_pct", "fg3_pct")}
    t = teams.groupBy(*SEASON).agg(F.count_distinct("team_id").alias("total_teams"), *(F.avg(v).alias(f"league_avg_team_{n}") for n, v in own.items()))
    return p.join(t, SEASON, "left")


@model("analytics_game_summary", "fact_game_result", "dim_game", "bridge_game_team", "dim_team")
def _(result, games, bridge, teams):
    out = games.select("game_id", "game_date", *SEASON, "matchup", "arena_name").join(result.select("game_id", "pts_home", "pts_away", "plus_minus_home", "wl_home", *LINE), "game_id")
    for side in ("home", "away"):
        out = look_up(out, bridge.filter(c("side") == side), same("game_id"), {f"{side}_team_id": "team_id"})
        out = look_up(out, teams, {f"{side}_team_id": "team_id"}, {f"{side}_team_name": "full_name", f"{side}_team_abbreviation": "abbreviation"})
    return out


@model("analytics_player_game_complete", "fact_player_game_traditional", "fact_player_game_advanced", "fact_player_game_misc", "fact_player_game_hustle", "fact_player_game_tracking", "dim_player", "dim_game", "dim_team")
def _(box, advanced, misc, hustle, tracking, players, games, teams):
    key = same("player_id", "game_id")
    out = box.select("player_id", "game_id", "team_id", "min", *(x for x in (*SHOOTING, *COUNTS)), "plus_minus")
    out = look_up(out, advanced, key, same("off_rating", "def_rating", "net_rating", "ast_pct", "ast_ratio", "reb_pct", "oreb_pct", "dreb_pct", "efg_pct", "ts_pct", "pace", "pie", "usg_pct"))
    out = look_up(out, misc, key, same(*MISC))
    out = look_up(out, hustle, key, same("contested_shots", "deflections", "loose_balls_recovered", "charges_drawn", "screen_assists"))
    out = look_up(out, tracking, key, same("dist", "spd", "tchs", "passes", "dfg_pct"))
    return with_names(look_up(out, games, same("game_id"), same("season_year", "game_date")), players, teams)


@model("analytics_team_game_complete", "fact_team_game", "fact_box_score_advanced_team", "fact_box_score_misc_team", "fact_team_game_hustle", "fact_box_score_player_track_team", "dim_team", "dim_game")
def _(team_games, advanced, misc, hustle, tracking, teams, games):
    """fact_team_game has no plus_minus of its own, so the column is null unless a staged one brings it."""
    key = same("team_id", "game_id")
    out = team_games.select("team_id", "game_id", *SHOOTING, *COUNTS, R.typed(team_games, "plus_minus", "double"))
    out = look_up(out, advanced, key, same("off_rating", "def_rating", "net_rating", "ast_pct", "reb_pct", "oreb_pct", "dreb_pct", "efg_pct", "ts_pct", "pace", "pie"))
    out = look_up(out, misc, key, same(*MISC))
    out = look_up(out, hustle, key, same("contested_shots", "deflections", "loose_balls_recovered", "charges_drawn", "screen_assists"))
    out = look_up(out, tracking, key, same("dist", "spd", "tchs", "passes"))
    out = look_up(out, games, same("game_id"), same("season_year", "game_date"))
    return look_up(out, teams, same("team_id"), {"team_name": "full_name", "team_abbreviation": "abbreviation"})


@model("analytics_player_season_complete", "agg_player_season", "agg_player_season_per36", "agg_player_season_per48", "dim_player", "dim_team")
def _(season, per36, per48, players, teams):
    own = [f"total_{x}" for x in ("min", "pts", "reb", "ast", "stl", "blk", "tov")] + ["avg_pts", "avg_reb", "avg_ast", "fg_pct", "fg3_pct", "ft_pct", "avg_off_rating", "avg_def_rating", "avg_net_rating", "avg_pie"]
    key = same("player_id", "team_id", *SEASON)
    out = season.select("player_id", *SEASON, "team_id", "gp", *own)
    for df, n in ((per36, 36), (per48, 48)):
        out = look_up(out, df, key, same(*(f"{x}_per{n}" for x in ("pts", "reb", "ast", "stl", "blk", "tov"))))
    return with_names(out, players, teams)


@model("analytics_team_season_summary", "agg_team_season", "fact_standings", "dim_team")
def _(season, standings, teams):
    out = season.select("team_id", *SEASON, "gp", "avg_pts", "avg_reb", "avg_ast", "fg_pct", "fg3_pct", "ft_pct")
    out = look_up(out, standings, same("team_id", *SEASON), same("wins", "losses", "win_pct", "conference", "conference_rank", "division", "division_rank"))
    return look_up(out, teams, same("team_id"), {"team_name": "full_name", "team_abbreviation": "abbreviation"})


@model("analytics_draft_value", "fact_draft", "agg_player_career", "dim_player")
def _(draft, career, players):
    out = draft.select("person_id", "season", "round_number", "round_pick", "overall_pick", "team_id", "player_name")
    out = look_up(out, career, {"person_id": "player_id"}, same(*(f"career_{x}" for x in ("gp", "pts", "ppg", "rpg", "apg", "fg_pct", "fg3_pct")), "seasons_played", "first_season", "last_season"))
    out = look_up(out, current(players), {"person_id": "player_id"}, {"_name": "full_name", "position": "position", "country": "country"})
    return out.withColumn("player_name", F.coalesce("_name", "player_name")).drop("_name")


@model("analytics_player_impact", "agg_on_off_splits", "agg_player_season", "dim_player", "dim_team")
def _(splits, season, players, teams):
    kept = "gp avg_min avg_pts avg_reb avg_ast fg_pct fg3_pct ft_pct avg_off_rating avg_def_rating avg_net_rating avg_ts_pct avg_usg_pct avg_pie".split()
    out = season.select("player_id", "team_id", *SEASON, *kept)
    mine = splits.filter(c("entity_type") == "player").withColumnRenamed("entity_id", "player_id")
    key = same("player_id", "team_id", *SEASON)
    rated = ["off_rating", "def_rating", "net_rating"]
    out = look_up(out, mine.filter(c("on_off") == "On"), key, {f"on_{x}": x for x in (*rated, "pts", "reb", "ast")})
    out = look_up(out, mine.filter(c("on_off") == "Off"), key, {f"off_{x}": x for x in rated})
    return with_names(out.withColumn("net_rating_diff", c("on_net_rating") - c("off_net_rating")), players, teams)


@model("analytics_player_matchup", "fact_player_matchups", "dim_player", "dim_team")
def _(matchups, players, teams):
    kept = ["player_id", "team_id", "vs_player_id", "season_year", "matchup_min", "player_pts", "team_pts", "ast", "tov", "stl", "blk", "fgm", "fga", "fg_pct", "fg3m", "fg3a", "fg3_pct"]
    out = matchups.select(*(x if x in matchups.columns else F.lit(None).alias(x) for x in kept))
    return look_up(with_names(out, players, teams), current(players), {"vs_player_id": "player_id"}, {"vs_player_name": "full_name"})


@model("analytics_clutch_performance", "fact_player_clutch_detail", "dim_player", "dim_team")
def _(clutch, players, teams):
    kept = ["player_id", "team_id", "season_year", "clutch_window", "gp", "w", "l", "min", *SHOOTING, *COUNTS, "plus_minus", "net_rating", "off_rating", "def_rating"]
    return with_names(clutch.select(*kept), players, teams)


@model("analytics_shooting_efficiency", "fact_shot_chart", "fact_shot_chart_league_averages", "dim_player", "dim_game")
def _(shots, league, players, games):
    zone = same("shot_zone_basic", "shot_zone_area", "shot_zone_range")
    out = shots.select("player_id", "game_id", "team_id", *zone, "shot_distance", "shot_type", "shot_made_flag", "loc_x", "loc_y")
    out = look_up(out, league, zone, {f"league_avg_{x}": x for x in ("fgm", "fga", "fg_pct")})
    out = look_up(out, current(players), same("player_id"), {"player_name": "full_name"})
    return look_up(out, games, same("game_id"), same("season_year", "game_date"))


def split_deltas(splits: DataFrame, key: str) -> DataFrame:
    """Each split beside the overall row of its player or team and season, with differences."""
    stats = ["w_pct", "min", "pts", "reb", "ast", "fg_pct", "fg3_pct", "ft_pct", "plus_minus"]
    ids = [key, *SEASON]
    overall = one_each(splits.filter(c("split_type") == "general_overall").select(*ids, "gp", *stats), ids, F.desc_nulls_last("gp"), F.desc_nulls_last("min"))
    out = splits.select(*ids, "split_type", "group_set", "group_value", "gp", "w", "l", *stats)
    out = look_up(out, overall, same(*ids), {f"overall_{x}": x for x in ("gp", *stats)})
    return out.select("*", ratio(c("gp"), c("overall_gp")).alias("gp_share"), *((c(x) - c(f"overall_{x}")).alias(f"{x}_delta") for x in stats))


@model("analytics_player_general_splits", "fact_player_general_splits_detail", "dim_player")
def _(splits, players):
    return look_up(split_deltas(splits, "player_id"), current(players), same("player_id"), {"player_name": "full_name"})


@model("analytics_team_general_splits", "fact_team_general_splits_detail", "dim_team")
def _(splits, teams):
    return look_up(split_deltas(splits, "team_id"), teams, same("team_id"), {"team_name": "full_name", "team_abbreviation": "abbreviation"})
