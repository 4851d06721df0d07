"""Feature tables of predictions and comparisons: games, seasons, curves of games, stint pairs, prospects, composites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tipoff.functions.scalars import ratio
from tipoff.operators import analysis as N
from tipoff.operators import windows as W
from tipoff.operators.joins import as_of


def head_to_head(games: DataFrame) -> DataFrame:
    """team, opponent, season: games, wins and mean margin of each side's meetings; games: home, away, season, pts_home, pts_away."""
    side = lambda a, b, x, y: games.select(F.col(a).alias("team"), F.col(b).alias("opponent"), "season", (F.col(x) - F.col(y)).alias("margin"))
    both = side("home", "away", "pts_home", "pts_away").unionByName(side("away", "home", "pts_away", "pts_home"))
    return both.groupBy("team", "opponent", "season").agg(F.count(F.lit(1)).alias("games"), F.count_if(F.col("margin") > 0).alias("wins"), F.avg("margin").alias("avg_margin"))


def game_features(games: DataFrame, box: DataFrame, metrics: list[str], n: int = 20) -> DataFrame:
    """A row for each game of two teams with form: what each side's last n games before it gave, differences, rest, and the last earlier season's head-to-head.

    games: game_id, day, season, home, away, pts_home, pts_away; box: game_id, team and the metrics. Every metric and the share of wins is a mean
    over the n games before (none of this one); a side without earlier games drops the game.
    """
    won = games.select("game_id", "day", F.explode(F.array(*(F.struct(F.col(t).alias("team"), (F.col(x) > F.col(y)).cast("double").alias("won")) for t, x, y in (("home", "pts_home", "pts_away"), ("away", "pts_away", "pts_home"))))).alias("s")).select("game_id", "day", "s.*")
    form = won.join(box, ["game_id", "team"])
    w = W.by(["team"], F.col("day"), F.col("game_id")).rowsBetween(-n, -1)
    form = form.select("game_id", "team", *(F.avg(m).over(w).alias(m) for m in metrics), F.avg("won").over(w).alias("win_pct"), F.count(F.lit(1)).over(w).alias("_n")).filter("_n > 0")
    all_ = [*metrics, "win_pct"]
    side = lambda s: form.select("game_id", F.col("team").alias(s), *(F.col(m).alias(f"{s}_{m}") for m in all_))
    rest = games
    for s in ("home", "away"):  # days since the side's last game in that role, as the source counts them
        rest = W.days_since(rest, [s], "day", [F.col("day"), F.col("game_id")]).withColumnRenamed("rest_days", f"{s}_rest")
    h2h = head_to_head(games).select("team", "opponent", "season", F.struct("games", "wins", "avg_margin").alias("h2h"))
    x = as_of(rest.withColumnsRenamed({"home": "team", "away": "opponent"}), h2h, ["team", "opponent"], "season", "h2h", F.col("game_id")).withColumnsRenamed({"team": "home", "opponent": "away"})
    x = x.join(side("home"), ["game_id", "home"]).join(side("away"), ["game_id", "away"])
    return x.select(
        "game_id", "day", "season", "home", "away", (F.col("pts_home") > F.col("pts_away")).cast("int").alias("target"),
        *(F.col(f"{s}_{m}") for s in ("home", "away") for m in all_), *((F.col(f"home_{m}") - F.col(f"away_{m}")).alias(f"{m}_diff") for m in all_),
        "home_rest", "away_rest", (F.col("home_rest") - F.col("away_rest")).alias("rest_diff"),
        F.col("prior_h2h.games").alias("h2h_games"), F.col("prior_h2h.wins").alias("h2h_wins"), F.col("prior_h2h.avg_margin").alias("h2h_avg_margin"),
    )


def season_features(base: DataFrame, keys: list[str], means: list[tuple[DataFrame, dict[str, str]]], kinds: DataFrame, kind: str, values: list[str], measures: list[str], team: DataFrame, team_keys: list[str], person: DataFrame, person_keys: list[str]) -> DataFrame:
    """A season's rows with features of five sources: means of two game-level sources, a pivot of play types (share and yield of each), the team's record and the person.

    means: (source, output name -> source column) by the keys; kinds: keys, a type and its measures, of which each listed type gets a column. Sources that lack a key leave nulls;
    each is brought to one row for each key before it is joined.
    """
    out = base
    for source, columns in means:
        out = out.join(source.groupBy(*keys).agg(*(F.avg(c).alias(n) for n, c in columns.items())), keys, "left")
    wide = kinds.groupBy(*keys).agg(*(F.max(F.when(F.col(kind) == v, F.col(m))).alias(f"{v.lower()}_{m}") for v in values for m in measures))
    out = out.join(wide, keys, "left")
    return out.join(team.dropDuplicates(team_keys), team_keys, "left").join(person.dropDuplicates(person_keys), person_keys, "left")


def volatile_curves(events: DataFrame, game: str, value: str, order: list[Column], cols: list[str], least: int = 50, top: int = 5) -> DataFrame:
    """The whole ordered curve of the `top` games whose value varies most (ties: the smaller game), of those with at least `least` values: drama, its rank, event_idx."""
    x = events.filter(F.col(value).isNotNull())
    s = x.groupBy(game).agg(F.stddev_samp(value).alias("drama"), F.count(F.lit(1)).alias("n_events")).filter(F.col("n_events") >= least)
    best = s.orderBy(F.desc_nulls_last("drama"), game).limit(top)
    best = best.withColumn("drama_rank", F.row_number().over(W.by([], F.desc_nulls_last("drama"), F.col(game))))  # `top` rows
    return x.join(F.broadcast(best), game).select(game, "drama", "drama_rank", "n_events", *cols, F.row_number().over(W.by([game], *order)).alias("event_idx"))


def stint_pairs(stints: DataFrame, keys: list[str], start: str, end: str, diff: str, least: float = 60.0, least_pair: float = 120.0, unit: float = 60.0) -> DataFrame:
    """Successive stints of each key: lengths in minutes, point differences and their rates a minute.

    Stints shorter than `least` seconds don't count; pairs with one below `least_pair` are left out.
    """
    x = stints.withColumn("len", (F.col(end) - F.col(start)).cast("double")).filter(F.col("len") >= least)
    w = W.by(keys, F.col(start), F.col(end))
    x = x.select(*keys, F.col(diff).alias("prev_diff"), (F.col("len") / unit).alias("prev_min"), F.lead(diff).over(w).alias("next_diff"), (F.lead("len").over(w) / unit).alias("next_min"), F.row_number().over(w).alias("stint"))
    x = x.filter((F.col("prev_min") >= least_pair / unit) & (F.col("next_min") >= least_pair / unit))
    return x.select("*", ratio(F.col("prev_diff"), F.col("prev_min")).alias("prev_rate"), ratio(F.col("next_diff"), F.col("next_min")).alias("next_rate"))


def prospects(measured: DataFrame, seasons: DataFrame, careers: DataFrame, draft: str, features: list[str], recent: int = 3, least_seasons: int = 4) -> DataFrame:
    """The most similar established player of each recent prospect: physical measures, the first season and the career, scaled over both groups, by cosine.

    measured: id, the draft season, measures; seasons: id, season, its measures; careers: id, seasons_played, .... Recent: of the last `recent` draft
    seasons; established: drafted before and at least `least_seasons` played. Rows that lack a feature are left out.
    """
    rookie = W.first_of(seasons, ["id"], F.col("season")).drop("season")
    x = measured.join(rookie, "id").join(careers, "id", "left").dropna(subset=features)
    cutoff = x.select(draft).distinct().orderBy(F.desc(draft)).limit(recent).agg(F.min(draft).alias("_cut"))
    x = x.join(F.broadcast(cutoff)).withColumn("_recent", F.col(draft) >= F.col("_cut")).filter("_recent or seasons_played >= %d" % least_seasons)
    z = W.z_scores(x, [], features).select("id", "_recent", F.array(*(f"{f}_z" for f in features)).alias("v"))
    return N.best_matches(z.filter("_recent"), z.filter("not _recent"), "id", "v")


def composite_check(profile: DataFrame, id_col: str, on_off: DataFrame, impact: str) -> DataFrame:
    """How the weighted composite agrees with equal weights and with the on/off difference: correlations, and how many of the top ten are the same.

    profile: id, score0, score1, ... and composite (see components_profile); on_off: id and the impact.
    """
    scores = [c for c in profile.columns if c.startswith("score")]
    x = profile.withColumn("equal", sum((F.col(s) for s in scores), F.lit(0.0)) / len(scores))
    best = lambda c: x.orderBy(F.desc(c), id_col).limit(10).select(id_col)
    same = best("composite").join(best("equal"), id_col).agg(F.count(F.lit(1)).alias("same_top_ten"))
    return x.join(on_off.select(id_col, impact), id_col, "left").agg(F.count(F.lit(1)).alias("n"), F.corr("composite", "equal").alias("with_equal"), F.corr("composite", impact).alias("with_on_off"), F.corr("equal", impact).alias("equal_with_on_off")).join(F.broadcast(same))
