"""Analysis jobs and curated questions on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tipoff.functions import scalars as S
from tipoff.operators import analysis as N
from tipoff.operators import joins as J
from tipoff.operators import windows as W
from tipoff.plans.catalogue import query, rounded
from tipoff.plans.core_queries import ISLANDS, lines, runs

c = F.col


def order_year():
    return F.year("o_orderdate")


def count_all():
    return F.count(F.lit(1))


@query("an_1_compare", "WITH s AS (SELECT c_mktsegment AS seg, avg(c_acctbal) AS bal FROM customer GROUP BY 1) SELECT seg, round(bal, 4) AS bal FROM s UNION ALL SELECT 'average', round(avg(bal), 4) FROM s")
def _(t):
    return rounded(N.with_average(t.customer.groupBy(c("c_mktsegment").alias("seg")).agg(F.avg("c_acctbal").alias("bal")), "seg", ["bal"]))


@query("an_2_breakouts", "SELECT o_orderkey, round((o_totalprice - m) / s, 5) AS sigmas FROM (SELECT o_orderkey, o_totalprice, avg(o_totalprice) OVER w AS m, stddev_samp(o_totalprice) OVER w AS s, count(*) OVER w AS n FROM orders WINDOW w AS (PARTITION BY o_custkey)) WHERE n >= 8 AND s > 0 AND o_totalprice >= m + 2 * s")
def _(t):
    return rounded(N.breakouts(t.orders, ["o_custkey"], "o_totalprice", 2.0, 8).select("o_orderkey", "sigmas"), 5)


@query("an_3_projection", "SELECT l_suppkey, round(q + r, 4) AS projected, round(q + r - 1.96 * sqrt(r), 4) AS low FROM (SELECT l_suppkey, sum(l_quantity) AS q, greatest(82 - count(DISTINCT l_partkey), 0) * sum(l_quantity) / count(DISTINCT l_partkey) AS r FROM lineitem GROUP BY 1)")
def _(t):
    s = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"), F.count_distinct("l_partkey").alias("g"))
    mid, low, _ = N.projection(c("q"), c("g"))
    return rounded(s.select("l_suppkey", mid.alias("projected"), low.alias("low")))


@query("an_4_wilson", """SELECT l_suppkey, round((p + k / (2 * n)) / (1 + k / n) - 1.959963984540054 * sqrt(p * (1 - p) / n + k / (4 * n * n)) / (1 + k / n), 6) AS low, round((p + k / (2 * n)) / (1 + k / n) + 1.959963984540054 * sqrt(p * (1 - p) / n + k / (4 * n * n)) / (1 + k / n), 6) AS high
FROM (SELECT l_suppkey, CAST(count(*) AS DOUBLE) AS n, count(*) FILTER (WHERE l_returnflag = 'R') / count(*) AS p, 1.959963984540054 * 1.959963984540054 AS k FROM lineitem GROUP BY 1)""")
def _(t):
    s = t.lineitem.groupBy("l_suppkey").agg(F.count_if(c("l_returnflag") == "R").alias("m"), count_all().alias("n"))
    lo, hi = N.wilson(c("m"), c("n"))
    return rounded(s.select("l_suppkey", lo.alias("low"), hi.alias("high")), 6)


@query("an_5_welch", """SELECT round((ma - mb) / sqrt(va / na + vb / nb), 6) AS t, round((ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)), 6) AS cohen_d FROM
(SELECT count(*) AS na, avg(value) AS ma, var_samp(value) AS va FROM events WHERE event_type = 'click'), (SELECT count(*) AS nb, avg(value) AS mb, var_samp(value) AS vb FROM events WHERE event_type = 'view')""")
def _(t):
    return rounded(N.welch(t.events, "event_type", "click", "view", "value").drop("dof"), 6)


@query("an_5_rank_sum", """WITH r AS (SELECT event_type, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS rk FROM events WHERE event_type IN ('click', 'view'))
SELECT round(sum(rk) FILTER (WHERE event_type = 'click') - count(*) FILTER (WHERE event_type = 'click') * (count(*) FILTER (WHERE event_type = 'click') + 1) / 2.0, 2) AS u FROM r""")
def _(t):
    return N.rank_sum(t.events, "event_type", "click", "view", "value").select(F.round(c("u"), 2).alias("u"))


@query("an_6_streaks", """WITH o AS (SELECT user_id, ts, event_id, CASE WHEN value > 50 THEN 1 ELSE 0 END AS w FROM events), s AS (SELECT *, CASE WHEN lag(w) OVER (PARTITION BY user_id ORDER BY ts, event_id) = w THEN 0 ELSE 1 END AS st FROM o),
i AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM s), r AS (SELECT user_id, g, w, count(*) AS len FROM i GROUP BY 1, 2, 3)
SELECT user_id, CAST(max(CASE WHEN w = 1 THEN len ELSE 0 END) AS BIGINT) AS longest, count(*) AS runs, round(2.0 * sum(len * w) * sum(len * (1 - w)) / sum(len) + 1, 5) AS expected_runs FROM r GROUP BY 1""")
def _(t):
    e = t.events.withColumn("w", F.when(c("value") > 50, 1).otherwise(0))
    return rounded(N.streaks(e, ["user_id"], [c("ts"), c("event_id")], "w").select("user_id", "longest", "runs", "expected_runs"), 5)


@query("an_7_similar", "WITH t AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 0) SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], e::DOUBLE[]), 6) AS cosine FROM embeddings, t WHERE vec_id <> 0 ORDER BY list_cosine_similarity(embedding::DOUBLE[], e::DOUBLE[]) DESC, vec_id LIMIT 10")
def _(t):
    return rounded(N.similar_to(t.embeddings, "vec_id", "embedding", 0), 6)


@query("an_8_edges", "SELECT src, dst FROM (SELECT a.vec_id AS src, b.vec_id AS dst, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) DESC, b.vec_id) AS r FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id) WHERE r <= 3")
def _(t):
    return N.similarity_edges(t.embeddings, "vec_id", "embedding", "label").select("src", "dst")


@query("an_9_aligned", """WITH p AS (SELECT o_custkey, year(o_orderdate) AS age, avg(o_totalprice) AS v FROM orders GROUP BY 1, 2), t0 AS (SELECT min(o_custkey) AS k FROM p), sd AS (SELECT stddev_samp(v) AS sd FROM p)
SELECT p.o_custkey, count(*) AS ages, round(avg(abs(p.v - q.v)) / max(sd), 5) AS distance FROM p, sd, t0 JOIN p q ON q.o_custkey = t0.k WHERE p.age = q.age AND p.o_custkey <> t0.k GROUP BY 1 HAVING count(*) >= 2""")
def _(t):
    p = t.orders.groupBy("o_custkey", order_year().alias("age")).agg(F.avg("o_totalprice").alias("v"))
    first = t.orders.agg(F.min("o_custkey")).collect()[0][0]
    return rounded(N.aligned_similarity(p, "o_custkey", "age", "v", first), 5)


@query("an_10_clusters")
def _(t):
    return N.clusters(t.embeddings, "embedding", [2, 3, 4])[0].groupBy("cluster").agg(count_all().alias("n"))


@query("an_11_components")
def _(t):
    return N.components_profile(t.embeddings.select("vec_id", "embedding"), "embedding").select("vec_id", "composite")


@query("an_12_peak")
def _(t):
    curve = t.part.groupBy("p_size").agg(F.avg("p_retailprice").alias("m"))
    return N.peak_fit(curve, "p_size", "m", [float(k) for k in range(5, 50, 5)], [2.0, 5.0, 10.0, 20.0])


@query("an_13_early_peak", "SELECT o_custkey, round(avg(o_totalprice) FILTER (WHERE r <= 3), 4) AS early, max(o_totalprice) FILTER (WHERE r > 3) AS peak FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) GROUP BY 1")
def _(t):
    r = t.orders.withColumn("r", F.row_number().over(W.by(["o_custkey"], c("o_orderdate"), c("o_orderkey"))))
    return r.groupBy("o_custkey").agg(F.round(F.avg(F.when(c("r") <= 3, c("o_totalprice"))), 4).alias("early"), F.max(F.when(c("r") > 3, c("o_totalprice"))).alias("peak"))


FORM = "SELECT o_orderkey, o_custkey, avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) AS form, coalesce(date_diff('day', lag(o_orderdate::DATE) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate::DATE), 3) AS rest FROM orders"


def form(t):
    w = [c("o_orderdate"), c("o_orderkey")]
    o = W.trailing_mean(t.orders, ["o_custkey"], w, "o_totalprice", [10], current=False).withColumn("day", c("o_orderdate").cast("date"))
    return W.days_since(o, ["o_custkey"], "day", w)


@query("an_14_16_features", f"SELECT o_orderkey, round(form, 7) AS form, CAST(rest AS INTEGER) AS rest, n_lines, round(avg_tax, 6) AS avg_tax FROM ({FORM}) f JOIN (SELECT l_orderkey, count(*) AS n_lines, avg(l_tax) AS avg_tax FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey")
def _(t):
    line = t.lineitem.groupBy(c("l_orderkey").alias("o_orderkey")).agg(count_all().alias("n_lines"), F.avg("l_tax").alias("avg_tax"))
    got = form(t).join(line, "o_orderkey")
    return got.select("o_orderkey", F.round("o_totalprice_avg_10", 7).alias("form"), c("rest_days").alias("rest"), "n_lines", F.round("avg_tax", 6).alias("avg_tax"))


@query("an_15_walk_forward")
def _(t):
    label = (c("o_orderstatus") == "F").cast("int").alias("label")
    d = form(t).select(order_year().alias("season"), label, c("o_totalprice").alias("price"), F.month("o_orderdate").cast("double").alias("month"), c("o_totalprice_avg_10").alias("form"), c("rest_days").cast("double").alias("rest"))
    got = N.walk_forward(d, "season", ["price", "month", "form", "rest"], "label")
    return got.groupBy("season").agg(F.round(F.avg(((c("probability") > 0.5).cast("int") == c("label")).cast("double")), 4).alias("accuracy"), count_all().alias("n"))


@query("an_17_volatile", "SELECT user_id, round(stddev_samp(value), 6) AS sd FROM events GROUP BY 1 HAVING count(*) >= 3 ORDER BY stddev_samp(value) DESC, user_id LIMIT 5")
def _(t):
    s = t.events.groupBy("user_id").agg(F.stddev_samp("value").alias("sd"), count_all().alias("n")).filter("n >= 3")
    return rounded(s.orderBy(F.desc("sd"), "user_id").limit(5).drop("n"), 6)


@query("an_18_clutch", "SELECT event_type, hour(ts) >= 18 AND abs(value - 50) <= 20 AS clutch, count(*) AS n, round(avg(value), 5) AS rate FROM events GROUP BY 1, 2 HAVING count(*) >= 5")
def _(t):
    clutch = (F.hour("ts") >= 18) & (F.abs(c("value") - 50) <= 20)
    return rounded(t.events.groupBy("event_type", clutch.alias("clutch")).agg(count_all().alias("n"), F.avg("value").alias("rate")).filter("n >= 5"), 5)


@query("an_19_quarters", "SELECT o_custkey, CAST(quarter(o_orderdate) AS INTEGER) AS q, round(sum(o_totalprice) - sum(sum(o_totalprice)) OVER (PARTITION BY o_custkey) / 4, 4) AS diff FROM orders GROUP BY 1, 2")
def _(t):
    s = t.orders.groupBy("o_custkey", F.quarter("o_orderdate").alias("q")).agg(F.sum("o_totalprice").alias("v"))
    from pyspark.sql import Window

    return s.select("o_custkey", "q", F.round(c("v") - F.sum("v").over(Window.partitionBy("o_custkey")) / 4, 4).alias("diff"))


@query("an_20_timeouts", "SELECT event_type, count(d) AS n, round(avg(d), 5) AS swing FROM (SELECT event_type, lead(value, 3) OVER (PARTITION BY user_id ORDER BY ts, event_id) - value AS d FROM events) GROUP BY 1")
def _(t):
    d = W.lead_after(t.events, ["user_id"], [c("ts"), c("event_id")], "value", 3).withColumn("d", c("value_after_3") - c("value"))
    return rounded(d.groupBy("event_type").agg(F.count("d").alias("n"), F.avg("d").alias("swing")), 5)


@query("an_21_hex_bins", """SELECT CASE WHEN da < db THEN ax ELSE bx END AS hx, CASE WHEN da < db THEN ay ELSE by_ END AS hy, count(*) AS n, round(avg(l_discount), 6) AS mean FROM (SELECT *, (u - ax) * (u - ax) + 3 * (v - ay) * (v - ay) AS da, (u - bx) * (u - bx) + 3 * (v - by_) * (v - by_) AS db FROM
(SELECT *, round(u) AS ax, round(v) AS ay, floor(u) + 0.5 AS bx, floor(v) + 0.5 AS by_ FROM (SELECT (l_quantity + 0.137) / 10.0 AS u, l_extendedprice / 1000.0 / (10.0 * sqrt(3.0)) AS v, l_discount FROM lineitem))) GROUP BY 1, 2 HAVING count(*) >= 20""")
def _(t):
    d = t.lineitem.select((c("l_quantity") + 0.137).alias("x"), (c("l_extendedprice") / 1000.0).alias("y"), "l_discount")
    return rounded(N.hex_bins(d, "x", "y", 10.0, "l_discount", 20), 6, "mean")


@query("an_22_rollup", f"SELECT year(o_orderdate) AS season, l_suppkey, count(*) AS n, round(sum(l_discount) / sum(l_quantity), 6) AS per FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2 HAVING sum(l_quantity) >= 100")
def _(t):
    s = lines(t).groupBy(order_year().alias("season"), "l_suppkey").agg(count_all().alias("n"), F.sum("l_quantity").alias("q"), F.sum("l_discount").alias("d")).filter("q >= 100")
    return s.select("season", "l_suppkey", "n", F.round(S.ratio(c("d"), c("q")), 6).alias("per"))


@query("an_23_value_classes", "SELECT c_custkey, CASE WHEN v >= 2000000 THEN 'star' WHEN v >= 1500000 THEN 'starter' WHEN v >= 500000 THEN 'rotation' ELSE 'bust' END AS outcome FROM (SELECT c_custkey, coalesce(sum(o_totalprice), 0) AS v FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1)")
def _(t):
    v = t.customer.join(t.orders.groupBy(c("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("v")), "c_custkey", "left").withColumn("v", F.coalesce("v", F.lit(0.0)))
    return v.select("c_custkey", F.when(c("v") >= 2e6, "star").when(c("v") >= 1.5e6, "starter").when(c("v") >= 5e5, "rotation").otherwise("bust").alias("outcome"))


@query("an_24_vs_league", "SELECT p_brand, round(sum(l_extendedprice) / sum(l_quantity) - (SELECT sum(l_extendedprice) / sum(l_quantity) FROM lineitem), 4) AS vs_league FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def _(t):
    b = t.lineitem.join(t.part, c("l_partkey") == c("p_partkey")).groupBy("p_brand").agg(S.ratio(F.sum("l_extendedprice"), F.sum("l_quantity")).alias("b"))
    league = t.lineitem.agg(S.ratio(F.sum("l_extendedprice"), F.sum("l_quantity")).alias("l"))
    return b.join(F.broadcast(league)).select("p_brand", F.round(c("b") - c("l"), 4).alias("vs_league"))


@query("an_25_run_sizes", f"WITH {ISLANDS}, r AS (SELECT user_id, island, event_type, count(*) AS len FROM i GROUP BY 1, 2, 3) SELECT event_type, CASE WHEN len >= 4 THEN 'long' WHEN len >= 2 THEN 'short' ELSE 'single' END AS bucket, count(*) AS n FROM r GROUP BY 1, 2")
def _(t):
    b = F.when(c("length") >= 4, "long").when(c("length") >= 2, "short").otherwise("single")
    return runs(t).groupBy("event_type", b.alias("bucket")).agg(count_all().alias("n"))


@query("an_26_prospects", "SELECT a.c_custkey, b.s_suppkey, round(abs(a.z - b.z), 5) AS d FROM (SELECT c_custkey, c_nationkey, (c_acctbal - avg(c_acctbal) OVER ()) / stddev_samp(c_acctbal) OVER () AS z FROM customer) a JOIN (SELECT s_suppkey, s_nationkey, (s_acctbal - avg(s_acctbal) OVER ()) / stddev_samp(s_acctbal) OVER () AS z FROM supplier) b ON c_nationkey = s_nationkey QUALIFY row_number() OVER (PARTITION BY a.c_custkey ORDER BY abs(a.z - b.z), b.s_suppkey) = 1")
def _(t):
    def scaled(df, col):
        s = df.agg(F.avg(col).alias("m"), F.stddev_samp(col).alias("sd"))
        return df.join(F.broadcast(s)).withColumn("z", F.try_divide(c(col) - c("m"), c("sd")))

    a = scaled(t.customer, "c_acctbal").select("c_custkey", c("c_nationkey").alias("k"), c("z").alias("za"))
    b = scaled(t.supplier, "s_acctbal").select("s_suppkey", c("s_nationkey").alias("k"), c("z").alias("zb"))
    d = J.nearest(a, b, ["k"], "za", "zb", "s_suppkey")
    return W.first_of(d, ["c_custkey"], c("d").asc_nulls_last(), c("s_suppkey")).select("c_custkey", "s_suppkey", F.round("d", 5).alias("d"))


# --- curated questions: the same names on the stand-in models, rows capped where the question is a top list


def question(name: str, sql: str):
    return query(f"q_{name}", sql)


SEASON = "SELECT year(o_orderdate) AS season_year, l_suppkey AS player_id, count(*) AS gp, round(avg(l_quantity), 4) AS ppg, round(avg(l_linenumber), 4) AS apg FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"


def season(t):
    return lines(t).groupBy(order_year().alias("season_year"), c("l_suppkey").alias("player_id")).agg(count_all().alias("gp"), F.round(F.avg("l_quantity"), 4).alias("ppg"), F.round(F.avg("l_linenumber"), 4).alias("apg"))


@question("player_season_scoring", f"{SEASON} ORDER BY ppg DESC, season_year, player_id LIMIT 20")
def _(t):
    return season(t).orderBy(F.desc("ppg"), "season_year", "player_id").limit(20)


@question("player_season_assists", f"{SEASON} ORDER BY apg DESC, season_year, player_id LIMIT 20")
def _(t):
    return season(t).orderBy(F.desc("apg"), "season_year", "player_id").limit(20)


@question("team_standings", "SELECT o_custkey AS team_id, count(*) FILTER (WHERE o_orderstatus = 'F') AS wins, count(*) FILTER (WHERE o_orderstatus = 'O') AS losses, round(count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 4) AS win_pct FROM orders GROUP BY 1")
def _(t):
    w = F.count_if(c("o_orderstatus") == "F")
    return t.orders.groupBy(c("o_custkey").alias("team_id")).agg(w.alias("wins"), F.count_if(c("o_orderstatus") == "O").alias("losses"), F.round(w / count_all(), 4).alias("win_pct"))


@question("pipeline_inventory", "SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'events', count(*) FROM events")
def _(t):
    from tipoff.operators.reshape import tagged_union

    return tagged_union({k: getattr(t, k).agg(count_all().alias("n")) for k in ("nation", "part", "events")}, "name").select("name", "n")


@question("head_to_head", "SELECT least(a.l_suppkey, b.l_suppkey) AS t1, greatest(a.l_suppkey, b.l_suppkey) AS t2, count(*) AS games FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = 1 AND b.l_linenumber = 2 GROUP BY 1, 2")
def _(t):
    from tipoff.operators.joins import self_pairs

    p = self_pairs(t.lineitem, ["l_orderkey"], "l_linenumber", 1, 2, ["l_suppkey"])
    return p.groupBy(F.least("home_l_suppkey", "away_l_suppkey").alias("t1"), F.greatest("home_l_suppkey", "away_l_suppkey").alias("t2")).agg(count_all().alias("games"))


@question("player_game_log", "SELECT l_suppkey AS player_id, l_orderkey AS game_id, o_orderdate AS game_date, l_quantity AS pts FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_suppkey = 1")
def _(t):
    return lines(t).filter("l_suppkey = 1").select(c("l_suppkey").alias("player_id"), c("l_orderkey").alias("game_id"), c("o_orderdate").alias("game_date"), c("l_quantity").alias("pts"))


@question("player_game_log_all", "SELECT l_suppkey AS player_id, l_orderkey AS game_id, o_orderdate AS game_date, l_quantity AS pts FROM lineitem JOIN orders ON l_orderkey = o_orderkey ORDER BY o_orderdate DESC")
def _(t):
    return lines(t).select(c("l_suppkey").alias("player_id"), c("l_orderkey").alias("game_id"), c("o_orderdate").alias("game_date"), c("l_quantity").alias("pts")).orderBy(F.desc("game_date"))


@question("league_benchmarks", f"SELECT season_year, round(avg(ppg), 3) AS avg_ppg, round(quantile_cont(ppg, 0.5), 4) AS p50, count(DISTINCT player_id) AS players FROM ({SEASON}) GROUP BY 1")
def _(t):
    return season(t).groupBy("season_year").agg(F.round(F.avg("ppg"), 3).alias("avg_ppg"), F.round(F.percentile("ppg", F.lit(0.5)), 4).alias("p50"), F.count_distinct("player_id").alias("players"))


@question("franchise_history", "SELECT o_custkey AS team_id, CAST(min(year(o_orderdate)) AS INTEGER) AS first_season, CAST(max(year(o_orderdate)) AS INTEGER) AS last_season, count(DISTINCT year(o_orderdate)) AS seasons FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy(c("o_custkey").alias("team_id")).agg(F.min(order_year()).alias("first_season"), F.max(order_year()).alias("last_season"), F.count_distinct(order_year()).alias("seasons"))


@question("team_roster", "SELECT DISTINCT n_name AS team, s_suppkey AS player_id, s_name AS player_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def _(t):
    return t.supplier.join(t.nation, c("s_nationkey") == c("n_nationkey")).select(c("n_name").alias("team"), c("s_suppkey").alias("player_id"), c("s_name").alias("player_name")).distinct()


@question("game_summary", "SELECT o_orderkey AS game_id, o_orderdate AS game_date, sum(l_quantity) AS pts, count(*) AS lines, max(l_quantity) AS top FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2")
def _(t):
    return lines(t).groupBy(c("o_orderkey").alias("game_id"), c("o_orderdate").alias("game_date")).agg(F.sum("l_quantity").alias("pts"), count_all().alias("lines"), F.max("l_quantity").alias("top"))


@question("player_season_rebounds", "SELECT year(o_orderdate) AS season_year, l_suppkey AS player_id, round(sum(l_tax), 4) AS reb FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2")
def _(t):
    return lines(t).groupBy(order_year().alias("season_year"), c("l_suppkey").alias("player_id")).agg(F.round(F.sum("l_tax"), 4).alias("reb"))


@question("team_pace", "SELECT o_custkey AS team_id, round(sum(l_quantity) / count(DISTINCT o_orderkey), 4) AS pace FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30")
def _(t):
    s = lines(t).groupBy(c("o_custkey").alias("team_id")).agg(F.round(F.sum("l_quantity") / F.count_distinct("o_orderkey"), 4).alias("pace"))
    return s.orderBy(F.desc("pace"), "team_id").limit(30)


@question("shot_chart", "SELECT p_brand AS zone, l_returnflag AS result, count(*) AS attempts, sum(l_quantity) AS made FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2")
def _(t):
    j = t.lineitem.join(t.part, c("l_partkey") == c("p_partkey"))
    return j.groupBy(c("p_brand").alias("zone"), c("l_returnflag").alias("result")).agg(count_all().alias("attempts"), F.sum("l_quantity").alias("made"))


@question("draft_value", "SELECT c_custkey AS player_id, CAST(rank() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC) AS INTEGER) AS pick, coalesce(n, 0) AS games FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def _(t):
    r = t.customer.withColumn("pick", F.rank().over(W.by(["c_nationkey"], c("c_acctbal").desc_nulls_last())))
    g = t.orders.groupBy(c("o_custkey").alias("c_custkey")).agg(count_all().alias("n"))
    return r.join(g, "c_custkey", "left").select(c("c_custkey").alias("player_id"), "pick", F.coalesce("n", F.lit(0)).alias("games"))


@question("team_season", "SELECT o_custkey AS team_id, year(o_orderdate) AS season_year, count(*) AS games, round(avg(o_totalprice), 4) AS ppg FROM orders GROUP BY 1, 2")
def _(t):
    return t.orders.groupBy(c("o_custkey").alias("team_id"), order_year().alias("season_year")).agg(count_all().alias("games"), F.round(F.avg("o_totalprice"), 4).alias("ppg"))


@question("player_season_complete", f"SELECT season_year, player_id, gp, ppg, s_name FROM ({SEASON}) JOIN supplier ON player_id = s_suppkey")
def _(t):
    return season(t).join(t.supplier.select(c("s_suppkey").alias("player_id"), "s_name"), "player_id", "left").select("season_year", "player_id", "gp", "ppg", "s_name")


@question("clutch_performance", "SELECT user_id, count(*) AS n, round(avg(value), 5) AS rate FROM events WHERE hour(ts) >= 18 GROUP BY 1 HAVING count(*) >= 3")
def _(t):
    return rounded(t.events.filter(F.hour("ts") >= 18).groupBy("user_id").agg(count_all().alias("n"), F.avg("value").alias("rate")).filter("n >= 3"), 5)


@question("player_matchups", "SELECT l_suppkey AS player_id, l_partkey AS defender_id, count(*) AS n, sum(l_quantity) AS pts FROM lineitem GROUP BY 1, 2")
def _(t):
    return t.lineitem.groupBy(c("l_suppkey").alias("player_id"), c("l_partkey").alias("defender_id")).agg(count_all().alias("n"), F.sum("l_quantity").alias("pts"))


@question("team_game_log", "SELECT o_custkey AS team_id, o_orderkey AS game_id, o_orderdate AS game_date, o_totalprice AS pts FROM orders WHERE o_custkey = 1")
def _(t):
    return t.orders.filter("o_custkey = 1").select(c("o_custkey").alias("team_id"), c("o_orderkey").alias("game_id"), c("o_orderdate").alias("game_date"), c("o_totalprice").alias("pts"))


@question("team_game_log_all", "SELECT o_custkey AS team_id, o_orderkey AS game_id, o_orderdate AS game_date, o_totalprice AS pts FROM orders ORDER BY o_orderdate DESC")
def _(t):
    return t.orders.select(c("o_custkey").alias("team_id"), c("o_orderkey").alias("game_id"), c("o_orderdate").alias("game_date"), c("o_totalprice").alias("pts")).orderBy(F.desc("game_date"))


@question("player_splits", "SELECT l_suppkey AS player_id, l_returnflag AS split, count(*) AS gp, round(avg(l_quantity), 5) AS ppg FROM lineitem GROUP BY 1, 2")
def _(t):
    return rounded(t.lineitem.groupBy(c("l_suppkey").alias("player_id"), c("l_returnflag").alias("split")).agg(count_all().alias("gp"), F.avg("l_quantity").alias("ppg")), 5)


@question("team_splits", "SELECT o_custkey AS team_id, o_orderpriority AS split, count(*) AS games FROM orders GROUP BY 1, 2")
def _(t):
    return t.orders.groupBy(c("o_custkey").alias("team_id"), c("o_orderpriority").alias("split")).agg(count_all().alias("games"))


@question("player_impact", "SELECT a.s AS player_id, round(a.q - b.q, 5) AS impact FROM (SELECT l_suppkey AS s, avg(l_quantity) AS q FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) a JOIN (SELECT l_suppkey AS s, avg(l_quantity) AS q FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) b ON a.s = b.s")
def _(t):
    from tipoff.operators.reshape import on_off

    s = t.lineitem.groupBy(c("l_suppkey").alias("player_id"), "l_linestatus").agg(F.avg("l_quantity").alias("q"))
    return on_off(s, ["player_id"], "l_linestatus", "F", "O", ["q"]).select("player_id", F.round("q_delta", 5).alias("impact"))


@question("shooting_efficiency", "SELECT p_brand AS zone, round(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) / count(*), 6) AS pct FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def _(t):
    j = t.lineitem.join(t.part, c("l_partkey") == c("p_partkey"))
    return j.groupBy(c("p_brand").alias("zone")).agg(F.round(S.ratio(F.count_if(c("l_returnflag") == "R"), count_all()), 6).alias("pct"))


@question("team_box_score", "SELECT l_orderkey AS game_id, l_returnflag AS side, sum(l_quantity) AS pts, count(*) AS players FROM lineitem GROUP BY 1, 2")
def _(t):
    return t.lineitem.groupBy(c("l_orderkey").alias("game_id"), c("l_returnflag").alias("side")).agg(F.sum("l_quantity").alias("pts"), count_all().alias("players"))


@question("player_box_score", "SELECT l_orderkey AS game_id, l_suppkey AS player_id, sum(l_quantity) AS pts, round(sum(l_discount), 4) AS ast FROM lineitem GROUP BY 1, 2")
def _(t):
    return t.lineitem.groupBy(c("l_orderkey").alias("game_id"), c("l_suppkey").alias("player_id")).agg(F.sum("l_quantity").alias("pts"), F.round(F.sum("l_discount"), 4).alias("ast"))


# --- published recipes


def recipe(name: str, sql: str):
    return query(f"g_{name}", sql)


@recipe("1_top_scorers", "SELECT l_suppkey AS player_id, count(*) AS gp, round(avg(l_quantity), 5) AS ppg FROM lineitem GROUP BY 1 HAVING count(*) >= 50 ORDER BY avg(l_quantity) DESC, 1 LIMIT 20")
def _(t):
    s = t.lineitem.groupBy(c("l_suppkey").alias("player_id")).agg(count_all().alias("gp"), F.avg("l_quantity").alias("ppg")).filter("gp >= 50")
    return rounded(s.orderBy(F.desc("ppg"), "player_id").limit(20), 5)


@recipe("2_career", "SELECT l_suppkey AS player_id, count(*) AS gp, round(avg(l_quantity), 5) AS ppg, count(DISTINCT year(l_shipdate)) AS seasons FROM lineitem GROUP BY 1 HAVING count(*) >= 200")
def _(t):
    s = t.lineitem.groupBy(c("l_suppkey").alias("player_id")).agg(count_all().alias("gp"), F.avg("l_quantity").alias("ppg"), F.count_distinct(F.year("l_shipdate")).alias("seasons"))
    return rounded(s.filter("gp >= 200"), 5)


@recipe("3_triple_doubles", "SELECT year(l_shipdate) AS season, l_suppkey AS player_id, count(*) AS n FROM lineitem WHERE l_quantity >= 30 AND l_discount >= 0.05 AND l_tax >= 0.05 GROUP BY 1, 2")
def _(t):
    hit = t.lineitem.filter("l_quantity >= 30 and l_discount >= 0.05D and l_tax >= 0.05D")
    return hit.groupBy(F.year("l_shipdate").alias("season"), c("l_suppkey").alias("player_id")).agg(count_all().alias("n"))


@recipe("4_efficient", "SELECT l_suppkey AS player_id, round(sum(l_extendedprice) / (2 * (sum(l_quantity) + 0.44 * sum(l_linenumber))), 4) AS ts FROM lineitem GROUP BY 1 HAVING count(*) >= 100")
def _(t):
    from tipoff.functions import metrics as M

    s = t.lineitem.groupBy(c("l_suppkey").alias("player_id")).agg(M.true_shooting(F.sum("l_extendedprice"), F.sum("l_quantity"), F.sum("l_linenumber")).alias("ts"), count_all().alias("n"))
    return rounded(s.filter("n >= 100").drop("n"))


@recipe("9_swings", "SELECT event_id, round(d, 6) AS swing FROM (SELECT event_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d FROM events) WHERE abs(d) >= 60")
def _(t):
    d = t.events.withColumn("d", c("value") - F.lag("value").over(W.by(["user_id"], c("ts"), c("event_id"))))
    return d.filter(F.abs("d") >= 60).select("event_id", F.round("d", 6).alias("swing"))


@recipe("13_conference_standings", "SELECT n_regionkey AS conference, c_custkey AS team_id, CAST(rank() OVER (PARTITION BY n_regionkey ORDER BY w DESC) AS INTEGER) AS seed FROM (SELECT n_regionkey, c_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS w FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)")
def _(t):
    w = t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).join(t.orders, c("o_custkey") == c("c_custkey")).groupBy(c("n_regionkey").alias("conference"), c("c_custkey").alias("team_id")).agg(F.count_if(c("o_orderstatus") == "F").alias("w"))
    return w.select("conference", "team_id", F.rank().over(W.by(["conference"], F.desc("w"))).alias("seed"))


@recipe("14_pruned_scan", "SELECT l_suppkey, l_quantity FROM lineitem WHERE year(l_shipdate) = 1995 AND l_quantity >= 45")
def _(t):
    from tipoff.sources import sinks

    path = sinks.work_dir(t.spark) + "/shots"
    sinks.write_parquet(t.lineitem.withColumn("season_year", F.year("l_shipdate")), path, "season_year")
    return t.spark.read.parquet(path).filter("season_year = 1995 and l_quantity >= 45").select("l_suppkey", "l_quantity")


@recipe("16_distance", "SELECT s_name, round(avg(l_extendedprice / 1000), 5) AS avg_distance FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1")
def _(t):
    return rounded(t.lineitem.join(t.supplier, c("l_suppkey") == c("s_suppkey")).groupBy("s_name").agg(F.avg(c("l_extendedprice") / 1000).alias("avg_distance")), 5)


@recipe("18_trend", "SELECT year(l_shipdate) AS season, round(avg(l_quantity), 5) AS ppg, round(avg(l_quantity) - lag(avg(l_quantity)) OVER (ORDER BY year(l_shipdate)), 5) AS change FROM lineitem WHERE l_suppkey = 1 GROUP BY 1")
def _(t):
    s = t.lineitem.filter("l_suppkey = 1").groupBy("l_suppkey", F.year("l_shipdate").alias("season")).agg(F.avg("l_quantity").alias("ppg"))
    return rounded(s.select("season", "ppg", (c("ppg") - F.lag("ppg").over(W.by(["l_suppkey"], c("season")))).alias("change")), 5)


@recipe("22_by_distance", "SELECT CAST(floor(l_extendedprice / 10000) AS BIGINT) AS bucket, count(*) AS attempts, round(count(*) FILTER (WHERE l_returnflag = 'R') / count(*), 6) AS pct FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy(F.floor(c("l_extendedprice") / 10000).alias("bucket")).agg(count_all().alias("attempts"), F.round(S.ratio(F.count_if(c("l_returnflag") == "R"), count_all()), 6).alias("pct"))


@recipe("23_top_lineups", "SELECT l_suppkey, l_linenumber, count(*) AS n, round(sum(l_tax * l_quantity) / sum(l_quantity), 6) AS net FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 50")
def _(t):
    from tipoff.operators.aggregates import weighted_mean

    s = t.lineitem.groupBy("l_suppkey", "l_linenumber").agg(count_all().alias("n"), weighted_mean(c("l_tax"), c("l_quantity")).alias("net"))
    return rounded(s.filter("n >= 50"), 6)


@recipe("25_on_off", "SELECT a.s AS l_suppkey, round(a.q - b.q, 5) AS delta FROM (SELECT l_suppkey AS s, avg(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) a JOIN (SELECT l_suppkey AS s, avg(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1) b ON a.s = b.s ORDER BY a.q - b.q DESC, a.s LIMIT 15")
def _(t):
    from tipoff.operators.reshape import on_off

    s = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.avg("l_quantity").alias("q"))
    d = on_off(s, ["l_suppkey"], "l_returnflag", "A", "N", ["q"]).orderBy(F.desc("q_delta"), "l_suppkey").limit(15)
    return d.select("l_suppkey", F.round("q_delta", 5).alias("delta"))
