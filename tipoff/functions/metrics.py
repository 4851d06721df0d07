"""Basketball metrics as column expressions: null inputs count as 0 and a zero denominator gives 0.0 unless noted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def z(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(0.0))


def safe(x: Column, y: Column) -> Column:
    return F.when(y == 0, 0.0).otherwise(F.try_divide(x, y))


def true_shooting(pts, fga, fta):
    return safe(z(pts), 2 * (z(fga) + 0.44 * z(fta)))


def effective_fg(fgm, fg3m, fga):
    return safe(z(fgm) + 0.5 * z(fg3m), z(fga))


def plays(fga, fta, tov):
    return z(fga) + 0.44 * z(fta) + z(tov)


def usage_rate(fga, fta, tov, minutes, team_fga, team_fta, team_tov, team_minutes):
    return safe(100 * plays(fga, fta, tov) * (z(team_minutes) / 5), z(minutes) * plays(team_fga, team_fta, team_tov))


def pace(poss, opp_poss, team_minutes):
    return safe(48 * (z(poss) + z(opp_poss)), 2 * (z(team_minutes) / 5))


def rating(points, poss):
    """Points for (offence) or against (defence) in 100 possessions."""
    return safe(100 * z(points), z(poss))


def net_rating(off, dfn):
    return z(off) - z(dfn)


def assist_to_turnover(ast, tov):
    """Null without turnovers."""
    return F.when(z(tov) != 0, z(ast) / z(tov))


def rebound_pct(reb, minutes, team_minutes, team_reb, opp_reb):
    return safe(100 * z(reb) * (z(team_minutes) / 5), z(minutes) * (z(team_reb) + z(opp_reb)))


def game_score(pts, fgm, fga, ftm, fta, oreb, dreb, stl, ast, blk, pf, tov):
    return (
        z(pts) + 0.4 * z(fgm) - 0.7 * z(fga) - 0.4 * (z(fta) - z(ftm)) + 0.7 * z(oreb) + 0.3 * z(dreb)
        + z(stl) + 0.7 * z(ast) + 0.7 * z(blk) - 0.4 * z(pf) - z(tov)
    )


def possessions(fga, fta, oreb, tov):
    return z(fga) - z(oreb) + z(tov) + 0.44 * z(fta)


def per_minutes(stat, minutes, base: float = 36.0):
    return safe(z(stat) * base, z(minutes))


def assist_pct(ast, minutes, team_minutes, team_fgm, fgm):
    return safe(100 * z(ast), (z(minutes) / (F.nullif(z(team_minutes), F.lit(0.0)) / 5)) * z(team_fgm) - z(fgm))


def steal_pct(stl, minutes, team_minutes, opp_poss):
    return safe(100 * z(stl) * (z(team_minutes) / 5), z(minutes) * z(opp_poss))


def block_pct(blk, minutes, team_minutes, opp_fga, opp_fg3a):
    return safe(100 * z(blk) * (z(team_minutes) / 5), z(minutes) * (z(opp_fga) - z(opp_fg3a)))


def turnover_pct(tov, fga, fta):
    return safe(100 * z(tov), plays(fga, fta, tov))


def per_base(df, base_col: str, stats: list[str], base: float, suffix: str):
    """A column family scaled to `base` units of base_col, 2 decimals; 0.0 where base_col is not positive."""
    return df.select("*", *(F.when(F.col(base_col) > 0, F.round(F.col(s) * base / F.col(base_col), 2)).otherwise(0.0).alias(f"{s}_{suffix}") for s in stats))
