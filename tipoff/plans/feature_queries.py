"""Feature tables of games and seasons, curves, stint pairs, prospects, composites, pruned neighbours and whole exports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tipoff.operators import analysis as N
from tipoff.operators import features as X
from tipoff.plans.catalogue import query, rounded
from tipoff.sources import sinks

c = F.col
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

#: Games of two nations: the customer's at home, the first other nation of its lines' suppliers away; odd lines score for the first, even ones for the second.
#: A unit in which no mean lies half-way between two rounded values.
UNIT = 7.013
GAMES = """
l AS (SELECT o_orderkey AS game_id, CAST(o_orderdate AS DATE) AS day, year(o_orderdate) AS season, c_nationkey AS home, s_nationkey AS other, l_linenumber % 2 = 1 AS odd, l_quantity AS q, l_extendedprice AS p, l_discount AS d
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey),
b AS (SELECT game_id, day, season, home, min(other) FILTER (WHERE other <> home) AS away, coalesce(sum(q) FILTER (WHERE odd), 0) AS pts_home, coalesce(sum(q) FILTER (WHERE NOT odd), 0) AS pts_away, avg(p) FILTER (WHERE odd) / 7.013 AS price_home, avg(p) FILTER (WHERE NOT odd) / 7.013 AS price_away,
  avg(d) FILTER (WHERE odd) / 7.013 AS disc_home, avg(d) FILTER (WHERE NOT odd) / 7.013 AS disc_away FROM l GROUP BY 1, 2, 3, 4),
g AS (SELECT * FROM b WHERE away IS NOT NULL)
"""


def games(t):
    x = t.orders.join(t.customer, c("o_custkey") == c("c_custkey")).join(t.lineitem, c("l_orderkey") == c("o_orderkey")).join(t.supplier, c("l_suppkey") == c("s_suppkey"))
    odd = c("l_linenumber") % 2 == 1
    side = lambda f, col, mine: f(F.when(mine, c(col)))
    g = x.groupBy(c("o_orderkey").alias("game_id"), c("o_orderdate").cast("date").alias("day"), F.year("o_orderdate").alias("season"), c("c_nationkey").alias("home")).agg(
        F.min(F.when(c("s_nationkey") != c("c_nationkey"), c("s_nationkey"))).alias("away"),
        F.coalesce(side(F.sum, "l_quantity", odd), F.lit(0.0)).alias("pts_home"), F.coalesce(side(F.sum, "l_quantity", ~odd), F.lit(0.0)).alias("pts_away"),
        *((side(F.avg, col, mine) / UNIT).alias(f"{n}_{s}") for n, col in (("price", "l_extendedprice"), ("disc", "l_discount")) for s, mine in (("home", odd), ("away", ~odd))),
    )
    return sinks.written(g.filter("away is not null"))


METRICS = ["price", "disc"]


@query("an_14_games", f"""WITH {GAMES},
s AS (SELECT game_id, day, home AS team, CAST(pts_home > pts_away AS INTEGER) AS won, price_home AS price, disc_home AS disc FROM g UNION ALL SELECT game_id, day, away, CAST(pts_away > pts_home AS INTEGER), price_away, disc_away FROM g),
f AS (SELECT game_id, team, avg(price) OVER w AS price, avg(disc) OVER w AS disc, avg(won) OVER w AS win, count(*) OVER w AS n FROM s WINDOW w AS (PARTITION BY team ORDER BY day, game_id ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
m AS (SELECT home AS team, away AS opponent, season, pts_home - pts_away AS margin FROM g UNION ALL SELECT away, home, season, pts_away - pts_home FROM g),
h AS (SELECT team, opponent, season, count(*) AS games, count(*) FILTER (WHERE margin > 0) AS wins, avg(margin) AS margin FROM m GROUP BY 1, 2, 3),
r AS (SELECT *, coalesce(date_diff('day', lag(day) OVER (PARTITION BY home ORDER BY day, game_id), day), 3) AS hr, coalesce(date_diff('day', lag(day) OVER (PARTITION BY away ORDER BY day, game_id), day), 3) AS ar FROM g)
SELECT r.game_id, r.day, CAST(r.season AS INTEGER) AS season, r.home, r.away, CAST(pts_home > pts_away AS INTEGER) AS target, round(x.price, 5) AS home_price, round(x.disc, 5) AS home_disc, round(x.win, 5) AS home_win_pct, round(y.price, 5) AS away_price, round(y.disc, 5) AS away_disc, round(y.win, 5) AS away_win_pct,
round(x.price - y.price, 5) AS price_diff, round(x.disc - y.disc, 5) AS disc_diff, round(x.win - y.win, 5) AS win_pct_diff, CAST(hr AS INTEGER) AS home_rest, CAST(ar AS INTEGER) AS away_rest, CAST(hr - ar AS INTEGER) AS rest_diff, h.games AS h2h_games, h.wins AS h2h_wins, round(h.margin, 5) AS h2h_avg_margin
FROM r JOIN f AS x ON x.game_id = r.game_id AND x.team = r.home AND x.n > 0 JOIN f AS y ON y.game_id = r.game_id AND y.team = r.away AND y.n > 0 ASOF LEFT JOIN h ON r.home = h.team AND r.away = h.opponent AND r.season > h.season""")
def _(t):
    """Form, differences, rest and the last earlier season's meetings of every game's two sides."""
    g = games(t)
    box = g.select("game_id", F.explode(F.array(*(F.struct(c(s).alias("team"), *(c(f"{m}_{s}").alias(m) for m in METRICS)) for s in ("home", "away")))).alias("b")).select("game_id", "b.*")
    return rounded(X.game_features(g, box, METRICS), 5)


@query("an_16_seasons", """
WITH l AS (SELECT l_suppkey AS id, year(l_shipdate) AS season, * FROM lineitem), base AS (SELECT id, season, count(*) AS gp, avg(l_quantity) AS avg_pts FROM l GROUP BY 1, 2 HAVING count(*) >= 10),
hustle AS (SELECT id, season, avg(l_discount) AS avg_discount, avg(l_tax) AS avg_tax FROM l WHERE l_returnflag = 'R' GROUP BY 1, 2), track AS (SELECT id, season, avg(o_totalprice) AS avg_total FROM l JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' GROUP BY 1, 2),
k AS (SELECT id, season, l_returnflag AS kind, sum(l_quantity) AS q, sum(l_extendedprice) AS p FROM l GROUP BY 1, 2, 3), s AS (SELECT id, season, kind, q / sum(q) OVER (PARTITION BY id, season) AS share, p / q AS per FROM k),
w AS (SELECT id, season, max(share) FILTER (WHERE kind = 'A') AS a_share, max(per) FILTER (WHERE kind = 'A') AS a_per, max(share) FILTER (WHERE kind = 'N') AS n_share, max(per) FILTER (WHERE kind = 'N') AS n_per, max(share) FILTER (WHERE kind = 'R') AS r_share, max(per) FILTER (WHERE kind = 'R') AS r_per FROM s GROUP BY 1, 2),
n AS (SELECT s_nationkey, season, count(*) AS games, count(*) FILTER (WHERE l_linestatus = 'F') AS wins FROM l JOIN supplier ON id = s_suppkey GROUP BY 1, 2), st AS (SELECT s_nationkey AS team, season, wins, games - wins AS losses, rank() OVER (PARTITION BY season ORDER BY wins DESC) AS team_rank FROM n)
SELECT CAST(b.id AS BIGINT) AS id, CAST(b.season AS INTEGER) AS season, gp, round(avg_pts, 7) AS avg_pts, round(avg_discount, 7) AS avg_discount, round(avg_tax, 7) AS avg_tax, round(avg_total, 7) AS avg_total, round(a_share, 7) AS a_share, round(a_per, 7) AS a_per, round(n_share, 7) AS n_share, round(n_per, 7) AS n_per, round(r_share, 7) AS r_share, round(r_per, 7) AS r_per,
wins, losses, CAST(team_rank AS INTEGER) AS team_rank, s_name FROM base b JOIN supplier ON b.id = s_suppkey LEFT JOIN hustle USING (id, season) LEFT JOIN track USING (id, season) LEFT JOIN w USING (id, season) LEFT JOIN st ON st.team = s_nationkey AND st.season = b.season""")
def _(t):
    """A player's season from five sources: its own averages, two game-level ones, play types, the team's standing and the person."""
    line = t.lineitem.withColumn("id", c("l_suppkey")).withColumn("season", F.year("l_shipdate"))
    keys = ["id", "season"]
    person = t.supplier.select(c("s_suppkey").alias("id"), c("s_nationkey").alias("team"), "s_name")
    base = line.groupBy(*keys).agg(F.count(F.lit(1)).alias("gp"), F.avg("l_quantity").alias("avg_pts")).filter("gp >= 10").join(person.select("id", "team"), "id")
    tracked = line.join(t.orders, c("l_orderkey") == c("o_orderkey")).filter("o_orderstatus = 'F'")
    sums = line.groupBy(*keys, c("l_returnflag").alias("kind")).agg(F.sum("l_quantity").alias("q"), F.sum("l_extendedprice").alias("p"))
    kinds = sums.join(sums.groupBy(*keys).agg(F.sum("q").alias("all")), keys).select(*keys, "kind", (c("q") / c("all")).alias("share"), (c("p") / c("q")).alias("per"))
    from tipoff.operators import windows as W

    teams = line.join(person, "id").groupBy("team", "season").agg(F.count(F.lit(1)).alias("games"), F.count_if(c("l_linestatus") == "F").alias("wins"))
    teams = teams.select("team", "season", "wins", (c("games") - c("wins")).alias("losses"), F.rank().over(W.by(["season"], F.desc("wins"))).alias("team_rank"))
    means = [(line.filter("l_returnflag = 'R'"), {"avg_discount": "l_discount", "avg_tax": "l_tax"}), (tracked, {"avg_total": "o_totalprice"})]
    got = X.season_features(base, keys, means, kinds, "kind", ["A", "N", "R"], ["share", "per"], teams, ["team", "season"], person.drop("team"), ["id"]).drop("team")
    return rounded(got, 7)


@query("an_17_curves", """
WITH s AS (SELECT user_id, stddev_samp(value) AS drama, count(*) AS n_events FROM events WHERE value IS NOT NULL GROUP BY 1 HAVING count(*) >= 20 ORDER BY drama DESC, user_id LIMIT 5), b AS (SELECT *, row_number() OVER (ORDER BY drama DESC, user_id) AS drama_rank FROM s)
SELECT user_id, round(drama, 6) AS drama, CAST(drama_rank AS INTEGER) AS drama_rank, n_events, event_id, round(value, 6) AS value, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS event_idx FROM events JOIN b USING (user_id) WHERE value IS NOT NULL""")
def _(t):
    return rounded(X.volatile_curves(t.events, "user_id", "value", [c("ts"), c("event_id")], ["event_id", "value"], 20), 6)


@query("an_20_stints", """
WITH e AS (SELECT user_id, event_type, epoch(ts) AS s, epoch(ts) + value * 20 AS t, value - 50 AS d, (value * 20) AS len FROM events),
x AS (SELECT user_id, event_type, d AS prev_diff, len / 60 AS prev_min, lead(d) OVER w AS next_diff, lead(len) OVER w / 60 AS next_min, row_number() OVER w AS stint FROM (SELECT *, t - s AS span FROM e) WHERE span >= 60 WINDOW w AS (PARTITION BY user_id, event_type ORDER BY s, t))
SELECT user_id, event_type, round(prev_diff, 4) AS prev_diff, round(prev_min, 4) AS prev_min, round(next_diff, 4) AS next_diff, round(next_min, 4) AS next_min, CAST(stint AS INTEGER) AS stint, round(prev_diff / prev_min, 4) AS prev_rate, round(next_diff / next_min, 4) AS next_rate FROM x WHERE prev_min >= 2 AND next_min >= 2""")
def _(t):
    s = F.unix_micros(c("ts").cast("timestamp")) / 1e6
    stints = t.events.select("user_id", "event_type", s.alias("s"), (s + c("value") * 20).alias("t"), (c("value") - 50).alias("d"))
    return rounded(X.stint_pairs(stints, ["user_id", "event_type"], "s", "t", "d"), 4)


@query("an_26_vectors", """
WITH o AS (SELECT o_custkey AS id, year(o_orderdate) AS season, avg(o_totalprice) AS price, count(*) AS games FROM orders GROUP BY 1, 2), k AS (SELECT id, min(season) AS draft, count(*) AS seasons_played FROM o GROUP BY 1),
r AS (SELECT o.id, price AS rookie_price, games AS rookie_games FROM o JOIN k ON o.id = k.id AND season = draft), p AS (SELECT c_custkey AS id, c_acctbal AS a, CAST(c_nationkey AS DOUBLE) AS b, draft, seasons_played, rookie_price AS x, CAST(rookie_games AS DOUBLE) AS y FROM customer JOIN k ON c_custkey = k.id JOIN r ON r.id = k.id),
cut AS (SELECT min(draft) AS d FROM (SELECT DISTINCT draft FROM p ORDER BY draft DESC LIMIT 3)), q AS (SELECT p.*, draft >= d AS recent FROM p, cut WHERE draft >= d OR seasons_played >= 4),
z AS (SELECT id, recent, [(a - avg(a) OVER ()) / stddev_samp(a) OVER (), (b - avg(b) OVER ()) / stddev_samp(b) OVER (), (x - avg(x) OVER ()) / stddev_samp(x) OVER (), (y - avg(y) OVER ()) / stddev_samp(y) OVER ()] AS v FROM q)
SELECT m.id AS src, n.id AS dst, round(list_cosine_similarity(m.v, n.v), 6) AS cosine FROM z m JOIN z n ON m.recent AND NOT n.recent QUALIFY row_number() OVER (PARTITION BY m.id ORDER BY list_cosine_similarity(m.v, n.v) DESC, n.id) = 1""")
def _(t):
    """Customers as prospects: account and nation are measured, first and later years of orders are seasons."""
    seasons = t.orders.groupBy(c("o_custkey").alias("id"), F.year("o_orderdate").alias("season")).agg(F.avg("o_totalprice").alias("rookie_price"), F.count(F.lit(1)).alias("rookie_games"))
    careers = seasons.groupBy("id").agg(F.min("season").alias("draft"), F.count(F.lit(1)).alias("seasons_played"))
    measured = t.customer.select(c("c_custkey").alias("id"), "c_acctbal", c("c_nationkey").cast("double").alias("nation")).join(careers.select("id", "draft"), "id")
    return rounded(X.prospects(measured, seasons, careers.drop("draft"), "draft", ["c_acctbal", "nation", "rookie_price", "rookie_games"]), 6)


@query("an_11_validated")
def _(t):
    """The composite beside equal weights and a difference on and off (here the label)."""
    profile = N.components_profile(t.embeddings.select("vec_id", "embedding"), "embedding")
    return rounded(X.composite_check(profile, "vec_id", t.embeddings.select("vec_id", c("label").cast("double").alias("impact")), "impact"), 6)


@query("an_8_pruned", "SELECT src, dst FROM (SELECT a.vec_id AS src, b.vec_id AS dst, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) DESC, b.vec_id) AS r FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id) WHERE r <= 3")
def _(t):
    """The edges of an_8_edges; pairs of blocks that can't hold one are not joined."""
    return N.pruned_edges(t.embeddings, "vec_id", "embedding", "label")[0].select("src", "dst")


@query("snk_5_catalogue", " UNION ALL ".join(f"SELECT '{n}' AS \"table\", 'parquet' AS format, TRUE AS ok, count(*) AS rows FROM {n} UNION ALL SELECT '{n}', 'csv', {'FALSE' if n == 'embeddings' else 'TRUE'}, NULL" for n in TABLES))
def _(t):
    """All tables of a database of the catalogue; one doesn't fit CSV, one is internal."""
    base, db = sinks.work_dir(t.spark), f"tipoff_{uuid.uuid4().hex[:12]}"
    t.spark.sql(f"CREATE DATABASE {db} LOCATION '{base}/db'")
    try:
        for n in [*TABLES, "_internal"]:
            t.spark.sql(f"CREATE TABLE {db}.{n} USING parquet LOCATION '{t.sf_dir}/{n.replace('_internal', 'region')}.parquet'")
        report = sinks.export_all(t.spark, db, f"{base}/out", ["parquet", "csv"], allow_partial=True)
    finally:
        t.spark.sql(f"DROP DATABASE {db} CASCADE")
    out = None
    for name, fmt, ok, _ in report:
        rows = t.spark.read.parquet(f"{base}/out/parquet/{name}").agg(F.count(F.lit(1)).alias("rows")) if ok and fmt == "parquet" else t.region.agg(F.lit(None).cast("bigint").alias("rows"))
        one = rows.select(F.lit(name).alias("table"), F.lit(fmt).alias("format"), F.lit(ok).alias("ok"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
