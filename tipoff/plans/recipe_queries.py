"""Published recipes and metrics beside those of the analysis queries; recipes about named players or teams give all of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tipoff.functions import metrics as M
from tipoff.functions import scalars as S
from tipoff.operators import windows as W
from tipoff.plans.analysis_queries import count_all, order_year, recipe
from tipoff.plans.catalogue import query, rounded
from tipoff.plans.core_queries import lines

c = F.col
MADE = "count(*) FILTER (WHERE l_returnflag = 'R')"


def made():
    return F.count_if(c("l_returnflag") == "R")


def zones(t):
    return t.lineitem.join(t.part, c("l_partkey") == c("p_partkey"))


@recipe("5_team_records", """SELECT n_name AS conference, c_name AS team, count(*) FILTER (WHERE o_orderstatus = 'F') AS wins, count(*) FILTER (WHERE o_orderstatus = 'O') AS losses,
round(count(*) FILTER (WHERE o_orderstatus = 'F') / nullif(count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')), 0), 6) AS win_pct FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2, c_custkey""")
def _(t):
    teams = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).select("c_custkey", "c_name", "n_name")
    won, lost = F.count_if(c("o_orderstatus") == "F"), F.count_if(c("o_orderstatus") == "O")
    s = t.orders.join(teams, c("o_custkey") == c("c_custkey")).groupBy("c_custkey", c("n_name").alias("conference"), c("c_name").alias("team")).agg(won.alias("wins"), lost.alias("losses"))
    s = s.select("conference", "team", "wins", "losses", F.round(S.ratio(c("wins"), c("wins") + c("losses")), 6).alias("win_pct"))
    return s.orderBy("conference", F.desc_nulls_last("win_pct"), "team")


@recipe("6_head_to_head_home", """SELECT a.l_suppkey AS home_id, b.l_suppkey AS away_id, count(*) AS games, count(*) FILTER (WHERE a.l_quantity > b.l_quantity) AS home_wins, round(avg(a.l_quantity - b.l_quantity), 5) AS margin
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = 1 AND b.l_linenumber = 2 GROUP BY 1, 2""")
def _(t):
    from tipoff.operators.joins import self_pairs

    p = self_pairs(t.lineitem, ["l_orderkey"], "l_linenumber", 1, 2, ["l_suppkey", "l_quantity"])
    s = p.groupBy(c("home_l_suppkey").alias("home_id"), c("away_l_suppkey").alias("away_id")).agg(
        count_all().alias("games"), F.count_if(c("home_l_quantity") > c("away_l_quantity")).alias("home_wins"), F.avg(c("home_l_quantity") - c("away_l_quantity")).alias("margin")
    )
    return rounded(s, 5).orderBy(F.desc("games"), "home_id", "away_id")


@recipe("7_pace_leaders", """SELECT o_custkey AS team_id, c_name AS team, count(DISTINCT o_orderkey) AS games, round(sum(l_quantity) / count(DISTINCT o_orderkey), 5) AS pace FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY 1, 2 HAVING count(DISTINCT o_orderkey) >= 5 ORDER BY sum(l_quantity) / count(DISTINCT o_orderkey) DESC, 1 LIMIT 30""")
def _(t):
    s = lines(t).join(t.customer, c("o_custkey") == c("c_custkey")).groupBy(c("o_custkey").alias("team_id"), c("c_name").alias("team")).agg(F.count_distinct("o_orderkey").alias("games"), F.sum("l_quantity").alias("q"))
    s = s.filter("games >= 5").withColumn("pace", c("q") / c("games")).orderBy(F.desc("pace"), "team_id").limit(30)
    return rounded(s.drop("q"), 5)


@recipe("8_player_zones", f"""SELECT l_suppkey AS player_id, p_brand AS zone, count(*) AS attempts, {MADE} AS made, round({MADE} / count(*), 6) AS pct, round(count(*) / sum(count(*)) OVER (PARTITION BY l_suppkey), 6) AS share
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def _(t):
    s = zones(t).groupBy(c("l_suppkey").alias("player_id"), c("p_brand").alias("zone")).agg(count_all().alias("attempts"), made().alias("made"))
    s = W.share(s.withColumn("pct", S.ratio(c("made"), c("attempts"))), ["player_id"], "attempts", "share")
    return rounded(s, 6).orderBy("player_id", F.desc("attempts"), "zone")


@recipe("10_clutch_shooting", f"""SELECT l_suppkey AS player_id, s_name AS player, count(*) AS attempts, {MADE} AS made, round({MADE} / count(*), 6) AS pct FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_linenumber >= 3 AND l_discount <= 0.05
GROUP BY 1, 2 HAVING count(*) >= 20 ORDER BY {MADE} / count(*) DESC, count(*) DESC, 1 LIMIT 25""")
def _(t):
    late = t.lineitem.filter((c("l_linenumber") >= 3) & (c("l_discount") <= 0.05)).join(t.supplier, c("l_suppkey") == c("s_suppkey"))
    s = late.groupBy(c("l_suppkey").alias("player_id"), c("s_name").alias("player")).agg(count_all().alias("attempts"), made().alias("made")).filter("attempts >= 20")
    s = s.withColumn("pct", S.ratio(c("made"), c("attempts"))).orderBy(F.desc("pct"), F.desc("attempts"), "player_id").limit(25)
    return rounded(s, 6)


@recipe("11_all_time_leaders", "SELECT s_name AS player, sum(l_quantity) AS pts, count(DISTINCT l_orderkey) AS games FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_suppkey, s_name ORDER BY sum(l_quantity) DESC, l_suppkey LIMIT 25")
def _(t):
    s = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("pts"), F.count_distinct("l_orderkey").alias("games"))
    s = s.join(t.supplier, c("l_suppkey") == c("s_suppkey")).orderBy(F.desc("pts"), "l_suppkey").limit(25)
    return s.select(c("s_name").alias("player"), "pts", "games")


@recipe("12_slice_zones", f"SELECT l_suppkey AS player_id, p_brand AS zone, count(*) AS attempts, {MADE} AS made FROM lineitem JOIN part ON l_partkey = p_partkey WHERE year(l_shipdate) = (SELECT max(year(l_shipdate)) FROM lineitem) GROUP BY 1, 2")
def _(t):
    from tipoff.sources import sinks

    path = sinks.work_dir(t.spark) + "/shots"
    sinks.write_parquet(t.lineitem.select("l_suppkey", "l_partkey", "l_returnflag", F.year("l_shipdate").alias("season")), path, "season")
    shots = t.spark.read.parquet(path)
    last = shots.agg(F.max("season")).collect()[0][0]  # one value, from the folders' names
    return shots.filter(c("season") == F.lit(last)).join(t.part, c("l_partkey") == c("p_partkey")).groupBy(c("l_suppkey").alias("player_id"), c("p_brand").alias("zone")).agg(count_all().alias("attempts"), made().alias("made"))


@recipe("15_attempts_per_season", "SELECT CAST(year(l_shipdate) AS INTEGER) AS season, count(*) AS attempts FROM lineitem GROUP BY 1")
def _(t):
    from tipoff.sources import sinks

    path = sinks.work_dir(t.spark) + "/attempts"
    sinks.write_parquet(t.lineitem.select("l_orderkey", F.year("l_shipdate").alias("season")), path, "season")
    return t.spark.read.parquet(path).groupBy("season").agg(count_all().alias("attempts")).orderBy("season")


@recipe("17_comparison", """SELECT s_name AS player, count(DISTINCT l_orderkey) AS gp, round(avg(l_quantity), 5) AS ppg, round(avg(l_linenumber), 5) AS apg, round(avg(l_tax), 6) AS rpg,
round(avg(l_quantity) - avg(avg(l_quantity)) OVER (), 5) AS ppg_vs_average FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY l_suppkey, s_name""")
def _(t):
    s = t.lineitem.join(t.supplier, c("l_suppkey") == c("s_suppkey")).groupBy("l_suppkey", c("s_name").alias("player")).agg(F.count_distinct("l_orderkey").alias("gp"), F.avg("l_quantity").alias("ppg"), F.avg("l_linenumber").alias("apg"), F.avg("l_tax").alias("rpg"))
    s = s.join(F.broadcast(s.agg(F.avg("ppg").alias("mean"))))  # one row
    return s.select("player", "gp", F.round("ppg", 5).alias("ppg"), F.round("apg", 5).alias("apg"), F.round("rpg", 6).alias("rpg"), F.round(c("ppg") - c("mean"), 5).alias("ppg_vs_average")).orderBy(F.desc("ppg"), "player")


@recipe("19_shooting", f"SELECT l_suppkey AS player_id, round({MADE} / count(*), 6) AS fg_pct, round(sum(l_extendedprice) / (2 * (sum(l_quantity) + 0.44 * sum(l_linenumber))), 4) AS ts FROM lineitem GROUP BY 1")
def _(t):
    s = t.lineitem.groupBy(c("l_suppkey").alias("player_id")).agg(F.round(S.ratio(made(), count_all()), 6).alias("fg_pct"), F.round(M.true_shooting(F.sum("l_extendedprice"), F.sum("l_quantity"), F.sum("l_linenumber")), 4).alias("ts"))
    return s


@recipe("20_late_game", f"SELECT l_suppkey AS player_id, count(*) AS attempts, {MADE} AS made, round({MADE} / count(*), 6) AS pct FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE date_diff('day', o_orderdate::DATE, l_shipdate::DATE) > 60 GROUP BY 1")
def _(t):
    late = lines(t).filter(F.date_diff("l_shipdate", "o_orderdate") > 60)
    s = late.groupBy(c("l_suppkey").alias("player_id")).agg(count_all().alias("attempts"), made().alias("made"))
    return rounded(s.withColumn("pct", S.ratio(c("made"), c("attempts"))), 6).orderBy(F.desc("pct"), "player_id")


@recipe("21_zone_efficiency", f"SELECT p_brand AS zone, p_size AS distance, count(*) AS attempts, round({MADE} / count(*), 6) AS pct, round(sum(CASE WHEN l_returnflag = 'R' THEN CASE WHEN p_size >= 25 THEN 3 ELSE 2 END ELSE 0 END) / count(*), 6) AS points_per_attempt FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2")
def _(t):
    pts = F.when(c("l_returnflag") == "R", F.when(c("p_size") >= 25, 3).otherwise(2)).otherwise(0)
    s = zones(t).groupBy(c("p_brand").alias("zone"), c("p_size").alias("distance")).agg(count_all().alias("attempts"), S.ratio(made(), count_all()).alias("pct"), S.ratio(F.sum(pts), count_all()).alias("points_per_attempt"))
    return rounded(s, 6).orderBy(F.desc("points_per_attempt"), "zone", "distance")


@recipe("24_rolling_form", """WITH top AS (SELECT l_suppkey AS p FROM lineitem GROUP BY 1 ORDER BY sum(l_quantity) DESC, 1 LIMIT 1)
SELECT l_orderkey AS game_id, l_linenumber AS line, l_quantity AS pts, round(avg(l_quantity) OVER (ORDER BY o_orderdate, l_orderkey, l_linenumber, l_quantity ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 5) AS form FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN top ON l_suppkey = p""")
def _(t):
    top = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q")).orderBy(F.desc("q"), "l_suppkey").limit(1).select(c("l_suppkey").alias("p"))
    g = lines(t).join(F.broadcast(top), c("l_suppkey") == c("p"))  # one row: the top scorer
    g = W.trailing_mean(g, ["l_suppkey"], [c("o_orderdate"), c("l_orderkey"), c("l_linenumber"), c("l_quantity")], "l_quantity", [5])
    return g.select(c("l_orderkey").alias("game_id"), c("l_linenumber").alias("line"), c("l_quantity").alias("pts"), F.round("l_quantity_avg_5", 5).alias("form"))


@recipe("26_scorers_with_games", "SELECT l_suppkey AS player_id, count(DISTINCT l_orderkey) AS gp, round(avg(l_quantity), 5) AS ppg FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_orderkey) >= 40 ORDER BY avg(l_quantity) DESC, 1 LIMIT 10")
def _(t):
    s = t.lineitem.groupBy(c("l_suppkey").alias("player_id")).agg(F.count_distinct("l_orderkey").alias("gp"), F.avg("l_quantity").alias("ppg")).filter("gp >= 40")
    return rounded(s.orderBy(F.desc("ppg"), "player_id").limit(10), 5)


@recipe("27_season_leaders", """SELECT l_suppkey AS player_id, sum(l_quantity) AS pts FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def _(t):
    last = t.orders.agg(F.max(order_year()).alias("last"))  # one row
    s = lines(t).join(F.broadcast(last), order_year() == c("last")).groupBy(c("l_suppkey").alias("player_id")).agg(F.sum("l_quantity").alias("pts"))
    return s.orderBy(F.desc("pts"), "player_id").limit(20)


@query("met_6_15_defence", """SELECT l_orderkey, l_linenumber, round(CASE WHEN tq = 0 THEN 0 ELSE 100 * (tp - p) / tq END, 4) AS drtg, round(CASE WHEN tq = 0 THEN 0 ELSE 100 * p / tq - 100 * (tp - p) / tq END, 3) AS net,
round(CASE WHEN tq = 0 OR (q / (tq / 5)) * tn - n = 0 THEN 0 ELSE 100 * n / ((q / (tq / 5)) * tn - n) END, 5) AS ast_pct, round(CASE WHEN q * (tp - tn) = 0 THEN 0 ELSE 100 * n * (tq / 5) / (q * (tp - tn)) END, 6) AS blk_pct
FROM (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_linenumber AS n, l_extendedprice AS p, sum(l_quantity) OVER w AS tq, sum(l_linenumber) OVER w AS tn, sum(l_extendedprice) OVER w AS tp FROM lineitem WINDOW w AS (PARTITION BY l_orderkey))""")
def _(t):
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey")
    d = t.lineitem.select("l_orderkey", "l_linenumber", c("l_quantity").alias("q"), c("l_linenumber").alias("n"), c("l_extendedprice").alias("p"), *(F.sum(x).over(w).alias(y) for x, y in (("l_quantity", "tq"), ("l_linenumber", "tn"), ("l_extendedprice", "tp"))))
    q, n, p, tq, tn, tp = (c(x) for x in ("q", "n", "p", "tq", "tn", "tp"))
    dfn = M.rating(tp - p, tq)
    return d.select("l_orderkey", "l_linenumber", F.round(dfn, 4).alias("drtg"), F.round(M.net_rating(M.rating(p, tq), dfn), 3).alias("net"), F.round(M.assist_pct(n, q, tq, tn, n), 5).alias("ast_pct"), F.round(M.block_pct(n, q, tq, tp, tn), 6).alias("blk_pct"))


@query("src_7_phases", "SELECT l_linenumber AS phase_id, CASE l_linenumber WHEN 1 THEN 'Preseason' WHEN 2 THEN 'Regular' WHEN 3 THEN 'Play-In' WHEN 4 THEN 'Playoffs R1' WHEN 5 THEN 'Playoffs R2' WHEN 6 THEN 'Conference Finals' WHEN 7 THEN 'Finals' WHEN 8 THEN 'All-Star' END AS phase_name, count(*) AS n, sum(l_quantity) AS pts FROM lineitem GROUP BY 1, 2")
def _(t):
    from tipoff.sources.staging import phases

    d = F.broadcast(phases(t.spark).select("phase_id", "phase_name"))  # eight rows
    return t.lineitem.withColumnRenamed("l_linenumber", "phase_id").join(d, "phase_id", "left").groupBy("phase_id", "phase_name").agg(count_all().alias("n"), F.sum("l_quantity").alias("pts"))
