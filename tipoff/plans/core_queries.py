"""Projections, filters, joins, aggregations, windows, sorts, sets and reshaping on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tipoff.functions import metrics as M
from tipoff.functions import scalars as S
from tipoff.operators import aggregates as A
from tipoff.operators import joins as J
from tipoff.operators import reshape as R
from tipoff.operators import selection
from tipoff.operators import windows as W
from tipoff.plans.catalogue import query, rounded

c = F.col


def order_year():
    return F.year("o_orderdate")

# --- scans and projections


@query("src_8_calendar", """
WITH b AS (SELECT min(o_orderdate)::DATE AS lo, max(o_orderdate)::DATE AS hi FROM orders),
d AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS day FROM b)
SELECT day, CAST(year(day) * 10000 + month(day) * 100 + day(day) AS INTEGER) AS date_key, CAST(isodow(day) AS INTEGER) AS weekday, isodow(day) >= 6 AS is_weekend,
CASE WHEN month(day) >= 10 THEN year(day) || '-' || lpad(CAST((year(day) + 1) % 100 AS VARCHAR), 2, '0') ELSE (year(day) - 1) || '-' || lpad(CAST(year(day) % 100 AS VARCHAR), 2, '0') END AS season FROM d""")
def _(t):
    from tipoff.sources.generators import calendar

    span = t.orders.agg(F.min("o_orderdate").cast("date").alias("lo"), F.max("o_orderdate").cast("date").alias("hi"))
    return calendar(span).select("day", "date_key", "weekday", "is_weekend", "season")


@query("src_9_season_strings", """
WITH b AS (SELECT min(year(o_orderdate)) AS lo, max(year(o_orderdate)) AS hi FROM orders)
SELECT y || '-' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS season FROM (SELECT unnest(generate_series(lo, hi)) AS y FROM b)""")
def _(t):
    b = t.orders.agg(F.min(order_year()).alias("lo"), F.max(order_year()).alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi")).alias("y")).select(S.season_label(c("y")).alias("season"))


@query("src_3_live_payload", "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.a.b') AS a_b, props IS NOT NULL AS has_payload FROM events")
def _(t):
    from tipoff.sources.payloads import project_payload

    return project_payload(t.events, "props", {"k": "k", "a_b": "a.b"}).select("event_id", "k", "a_b", c("props").isNotNull().alias("has_payload"))


@query("src_4_nested_schedule", "SELECT o_orderkey AS game_id, l_linenumber AS line, l_suppkey AS player_id, l_quantity AS pts FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def _(t):
    from tipoff.sources.payloads import flatten_nested

    nested = t.orders.join(t.lineitem, c("o_orderkey") == c("l_orderkey")).groupBy(c("o_orderkey").alias("game_id")).agg(
        F.collect_list(F.struct(c("l_linenumber").alias("line"), c("l_suppkey").alias("player_id"), c("l_quantity").alias("pts"))).alias("lines"))
    return flatten_nested(nested, "lines", ["game_id"])


@query("src_6_coercion", "SELECT p_partkey, TRY_CAST(p_name AS DOUBLE) AS as_number, TRY_CAST(substr(p_brand, length(p_brand)) AS DOUBLE) AS brand_digit FROM part")
def _(t):
    return t.part.select("p_partkey", c("p_name").try_cast("double").alias("as_number"), F.expr("substr(p_brand, length(p_brand))").try_cast("double").alias("brand_digit"))


@query("prj_1_passthrough", "SELECT * FROM region")
def _(t):
    return t.region


@query("prj_2_rename", "SELECT p_partkey AS part_id, p_name AS name, p_size AS size FROM part")
def _(t):
    return t.part.select(c("p_partkey").alias("part_id"), c("p_name").alias("name"), c("p_size").alias("size"))


@query("prj_3_star_minus", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment, n_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey")
def _(t):
    return t.customer.join(t.nation, c("c_nationkey") == c("n_nationkey")).drop("c_nationkey", "n_nationkey")


@query("prj_4_ratio", "SELECT l_orderkey, l_linenumber, round(l_extendedprice / nullif(l_quantity, 0), 8) AS per_unit, round(l_tax * 36.0 / nullif(l_discount, 0), 8) AS per36 FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(S.ratio(c("l_extendedprice"), c("l_quantity")), 8).alias("per_unit"), F.round(S.ratio(c("l_tax") * 36.0, c("l_discount")), 8).alias("per36"))


@query("prj_5_case", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'win' WHEN 'O' THEN 'loss' ELSE 'unknown' END AS result, o_orderpriority IN ('1-URGENT', '2-HIGH') AS starter FROM orders")
def _(t):
    return t.orders.select("o_orderkey", S.code_name(c("o_orderstatus"), {"F": "win", "O": "loss"}).alias("result"), c("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("starter"))


@query("prj_6_typed_or_null", "SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, CAST(NULL AS DOUBLE) AS p_weight FROM part")
def _(t):
    return t.part.select("p_partkey", R.typed(t.part, "p_size", "long"), R.typed(t.part, "p_weight", "double"))


@query("prj_7_try_cast", "SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS level, TRY_CAST(o_orderpriority AS INTEGER) AS bad FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).try_cast("int").alias("level"), c("o_orderpriority").try_cast("int").alias("bad"))


@query("prj_8_conform", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_phone FROM customer")
def _(t):
    from tipoff.operators.quality import conform

    return conform(t.customer, {"c_custkey": "long", "c_name": "string", "c_nationkey": "long", "c_acctbal": "double", "c_phone": "string"}, optional={"c_phone"})


@query("prj_9_names", "SELECT s_suppkey AS supp_key, s_name AS team_name FROM supplier")
def _(t):
    raw = t.supplier.select(c("s_suppkey").alias("SuppKey"), c("s_name").alias("TEAM"))
    return raw.toDF(*S.snake_names(raw.columns, {"team": "team_name"}))


@query("prj_10_tag", "SELECT c_custkey, c_mktsegment, 'customer' AS entity_type FROM customer")
def _(t):
    return t.customer.select("c_custkey", "c_mktsegment", F.lit("customer").alias("entity_type"))


@query("flt_1_predicates", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate IS NOT NULL AND l_returnflag = 'R' AND l_quantity >= 10")
def _(t):
    return t.lineitem.filter("l_shipdate is not null and l_returnflag = 'R' and l_quantity >= 10").select("l_orderkey", "l_linenumber")


@query("flt_2_in_like", "SELECT p_partkey FROM part WHERE p_size IN (1, 5, 9) OR p_type ILIKE '%steel%'")
def _(t):
    return t.part.filter(c("p_size").isin(1, 5, 9) | c("p_type").ilike("%steel%")).select("p_partkey")


@query("flt_3_interval", "SELECT o_orderkey FROM orders WHERE year(o_orderdate) BETWEEN 1994 AND 1995")
def _(t):
    return t.orders.filter(order_year().between(1994, 1995)).select("o_orderkey")


@query("flt_4_lookback", "SELECT event_id FROM events WHERE ts::DATE >= (SELECT max(ts)::DATE - 7 FROM events)")
def _(t):
    last = t.events.agg(F.max("ts").cast("date").alias("asof"))
    return t.events.join(F.broadcast(last)).filter(c("ts").cast("date") >= F.date_sub("asof", 7)).select("event_id")


@query("flt_5_latest", "SELECT o_orderkey FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)")
def _(t):
    return t.orders.join(F.broadcast(t.orders.agg(F.max(order_year()).alias("y")))).filter(order_year() == c("y")).select("o_orderkey")


@query("flt_7_availability", "SELECT DISTINCT year(o_orderdate) AS year, o_orderstatus AS kind, CASE WHEN o_orderstatus = 'P' AND year(o_orderdate) < 1995 THEN 'upstream_unavailable' ELSE 'supported' END AS status FROM orders")
def _(t):
    return t.orders.select(order_year().alias("year"), c("o_orderstatus").alias("kind")).distinct().withColumn("status", S.availability(c("year"), c("kind"), {"P": 1995}))


@query("flt_8_stratified", "SELECT year, count(*) AS n FROM (SELECT year(o_orderdate) AS year, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) AS r FROM orders) WHERE r <= 50 GROUP BY year")
def _(t):
    got = W.first_of(t.orders.withColumn("year", order_year()), ["year"], F.xxhash64("o_orderkey", F.lit(42)), c("o_orderkey"), n=50)
    return got.groupBy("year").agg(F.count(F.lit(1)).alias("n"))


# --- joins

LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"


def lines(t):
    return t.lineitem.join(t.orders, c("l_orderkey") == c("o_orderkey"))


@query("join_1_inner", f"SELECT l_orderkey, l_linenumber, o_custkey FROM {LINES}")
def _(t):
    return lines(t).select("l_orderkey", "l_linenumber", "o_custkey")


@query("join_2_star", f"SELECT l_orderkey, l_linenumber, c_name, n_name, p_brand FROM {LINES} LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN part ON l_partkey = p_partkey")
def _(t):
    fact = lines(t).select("l_orderkey", "l_linenumber", c("o_custkey").alias("c_custkey"), c("l_partkey").alias("p_partkey"))
    nat = t.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    return J.enrich(fact, (t.customer, ["c_custkey"]), (nat, ["c_nationkey"]), (t.part, ["p_partkey"])).select("l_orderkey", "l_linenumber", "c_name", "n_name", "p_brand")


@query("join_3_full", "SELECT coalesce(a.k, b.k) AS k, n_cust, n_supp FROM (SELECT c_nationkey AS k, count(*) AS n_cust FROM customer WHERE c_nationkey < 15 GROUP BY 1) a FULL OUTER JOIN (SELECT s_nationkey AS k, count(*) AS n_supp FROM supplier GROUP BY 1) b ON a.k = b.k")
def _(t):
    a = t.customer.filter("c_nationkey < 15").groupBy(c("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n_cust"))
    return J.full_outer(a, t.supplier.groupBy(c("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n_supp")), ["k"])


@query("join_4_using", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(t):
    return t.nation.withColumnRenamed("n_regionkey", "k").join(t.region.withColumnRenamed("r_regionkey", "k"), "k").select("n_nationkey", "n_name", "r_name")


@query("join_5_home_away", "SELECT a.o AS o, a.q AS home_q, b.q AS away_q FROM (SELECT l_orderkey AS o, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) a JOIN (SELECT l_orderkey AS o, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) b ON a.o = b.o")
def _(t):
    s = t.lineitem.groupBy(c("l_orderkey").alias("o"), "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    return J.self_pairs(s, ["o"], "l_returnflag", "A", "R", ["q"])


@query("join_6_role_playing", f"SELECT l_orderkey, l_linenumber, cn.n_name AS cust_nation, sn.n_name AS supp_nation FROM {LINES} JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation sn ON s_nationkey = sn.n_nationkey")
def _(t):
    cn = t.nation.select(c("n_nationkey").alias("c_nationkey"), c("n_name").alias("cust_nation"))
    sn = t.nation.select(c("n_nationkey").alias("s_nationkey"), c("n_name").alias("supp_nation"))
    got = lines(t).join(t.customer, c("o_custkey") == c("c_custkey")).join(t.supplier, c("l_suppkey") == c("s_suppkey")).join(cn, "c_nationkey").join(sn, "s_nationkey")
    return got.select("l_orderkey", "l_linenumber", "cust_nation", "supp_nation")


SCD = """v AS (SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS p FROM orders),
ch AS (SELECT o_custkey, o_orderdate AS valid_from, o_orderkey, o_orderstatus FROM v WHERE p IS NULL OR p <> o_orderstatus),
scd AS (SELECT o_custkey, o_orderstatus, valid_from, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from, o_orderkey) AS valid_to FROM ch)"""


def customer_status(t):
    o = t.orders.select("o_custkey", "o_orderstatus", c("o_orderdate").alias("valid_from"), "o_orderkey")
    ch = W.changes(o, ["o_custkey"], [c("valid_from"), c("o_orderkey")], ["o_orderstatus"])
    nxt = F.lead("valid_from").over(W.by(["o_custkey"], c("valid_from"), c("o_orderkey")))
    return ch.withColumn("valid_to", nxt).withColumn("is_current", c("valid_to").isNull()).drop("o_orderkey")


@query("win_5_6_scd2", f"WITH {SCD} SELECT o_custkey, o_orderstatus, valid_from, valid_to, valid_to IS NULL AS is_current FROM scd")
def _(t):
    return customer_status(t)


@query("join_7_scd2_current", f"WITH {SCD} SELECT c_custkey, o_orderstatus FROM customer LEFT JOIN scd ON c_custkey = o_custkey AND valid_to IS NULL")
def _(t):
    return J.current_join(t.customer, customer_status(t).withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"]).select("c_custkey", "o_orderstatus")


@query("join_8_anti", "SELECT count(*) AS orphans FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def _(t):
    return J.orphans(t.customer, "c_custkey", t.orders, "o_custkey").agg(F.count(F.lit(1)).alias("orphans"))


@query("join_9_semi", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def _(t):
    return t.customer.join(t.orders.select(c("o_custkey").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey")


@query("join_10_one_row_cross", "SELECT round(a.s, 2) AS order_total, b.n AS n_lines FROM (SELECT sum(o_totalprice) AS s FROM orders) a, (SELECT count(*) AS n FROM lineitem) b")
def _(t):
    return t.orders.agg(F.round(F.sum("o_totalprice"), 2).alias("order_total")).crossJoin(t.lineitem.agg(F.count(F.lit(1)).alias("n_lines")))


@query("join_11_nth_after", "WITH e AS (SELECT *, lead(value, 10) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS later FROM events) SELECT event_id, user_id, round(value, 6) AS value, round(later, 6) AS value_after_10 FROM e WHERE event_type = 'purchase'")
def _(t):
    got = W.lead_after(t.events, ["user_id"], [c("ts"), c("event_id")], "value", 10).filter("event_type = 'purchase'")
    return rounded(got.select("event_id", "user_id", "value", "value_after_10"), 6)


@query("join_12_range", """WITH e AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events)
SELECT m.user_id, m.seq AS mark_seq, e.event_id FROM e m JOIN e ON e.user_id = m.user_id AND e.seq < m.seq AND e.seq >= m.seq - 5 WHERE m.event_type = 'purchase'""")
def _(t):
    e = t.events.withColumn("seq", F.row_number().over(W.by(["user_id"], c("ts"), c("event_id"))))
    return J.range_before(e, e.filter("event_type = 'purchase'"), ["user_id"], "seq", 5).select("user_id", "mark_seq", "event_id")


@query("join_13_as_of", """SELECT l.l_orderkey, l.l_linenumber, round((SELECT max_by(o_totalprice, o_orderdate) FROM (SELECT o_custkey, o_orderdate::DATE AS o_orderdate, max(o_totalprice) AS o_totalprice FROM orders GROUP BY 1, 2) p WHERE p.o_custkey = l.o_custkey AND p.o_orderdate < l.day), 2) AS prior_total
FROM (SELECT l_orderkey, l_linenumber, o_custkey, o_orderdate::DATE AS day FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber = 1) l""")
def _(t):
    facts = lines(t).filter("l_linenumber = 1").select("l_orderkey", "l_linenumber", "o_custkey", c("o_orderdate").cast("date").alias("day"))
    hist = t.orders.groupBy("o_custkey", c("o_orderdate").cast("date").alias("day")).agg(F.max("o_totalprice").alias("total"))
    return J.as_of(facts, hist, ["o_custkey"], "day", "total", c("l_orderkey")).select("l_orderkey", "l_linenumber", F.round("prior_total", 2).alias("prior_total"))


@query("join_14_successor", "SELECT a.conv_id, a.turn, b.role AS next_role FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn - 1")
def _(t):
    w = W.by(["conv_id"], c("turn"))
    return t.conversations.withColumn("next_role", F.lead("role").over(w)).withColumn("nt", F.lead("turn").over(w)).filter("nt = turn + 1").select("conv_id", "turn", "next_role")


@query("join_15_scalar_subquery", "SELECT o_orderkey FROM orders o WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders i WHERE i.o_custkey = o.o_custkey)")
def _(t):
    from pyspark.sql import Window

    return t.orders.withColumn("m", F.avg("o_totalprice").over(Window.partitionBy("o_custkey"))).filter("o_totalprice > m").select("o_orderkey")


@query("join_16_benchmark", "SELECT p_partkey, round(p_retailprice - a, 4) AS vs_zone FROM part JOIN (SELECT p_brand AS b, p_type AS ty, avg(p_retailprice) AS a FROM part GROUP BY 1, 2) ON p_brand = b AND p_type = ty")
def _(t):
    avg = t.part.groupBy("p_brand", "p_type").agg(F.avg("p_retailprice").alias("a"))
    return t.part.join(avg, ["p_brand", "p_type"], "left").select("p_partkey", F.round(c("p_retailprice") - c("a"), 4).alias("vs_zone"))


# --- aggregations


@query("agg_1_pricing_summary", "SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem GROUP BY 1, 2")
def _(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count(F.lit(1)).alias("n"))


@query("agg_2_ratio_of_sums", "SELECT l_suppkey, round(sum(l_extendedprice * l_discount) / nullif(sum(l_extendedprice), 0), 6) AS share FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.round(A.ratio_of_sums(c("l_extendedprice") * c("l_discount"), c("l_extendedprice")), 6).alias("share"))


@query("agg_3_distinct", "SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("n_parts"))


@query("agg_4_bounds", "SELECT year(o_orderdate) AS year, min(o_orderdate) AS first_day, max(o_orderdate) AS last_day FROM orders GROUP BY 1")
def _(t):
    return t.orders.groupBy(order_year().alias("year")).agg(F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"))


@query("agg_5_conditional", "SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS n_r, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS q_a FROM lineitem GROUP BY 1")
def _(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.count_if(c("l_returnflag") == "R").alias("n_r"), F.sum(F.when(c("l_returnflag") == "A", c("l_quantity")).otherwise(0)).alias("q_a"))


@query("agg_6_two_level", "SELECT o_custkey, count(*) AS games, round(avg(pts), 4) AS ppg FROM (SELECT o_custkey, o_orderkey, sum(l_quantity) AS pts FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) GROUP BY 1")
def _(t):
    game = lines(t).groupBy("o_custkey", "o_orderkey").agg(F.sum("l_quantity").alias("pts"))
    return game.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("games"), F.round(F.avg("pts"), 4).alias("ppg"))


@query("agg_7_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 15")
def _(t):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).filter("n >= 15")


@query("agg_8_dedupe", "SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text")
def _(t):
    return t.documents.groupBy("text").agg(F.min("doc_id").alias("doc_id"))


@query("agg_9_volatility", "SELECT user_id, round(stddev_samp(value), 6) AS sd FROM events GROUP BY 1")
def _(t):
    return rounded(t.events.groupBy("user_id").agg(F.stddev_samp("value").alias("sd")), 6)


@query("agg_10_quantiles", "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50, round(quantile_cont(l_extendedprice, 0.95), 4) AS p95 FROM lineitem GROUP BY 1")
def _(t):
    return rounded(selection.quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", {"p50": 0.5, "p95": 0.95}))


@query("agg_11_pivot", "SELECT user_id, max(CASE WHEN event_type = 'click' THEN value END) AS click, max(CASE WHEN event_type = 'purchase' THEN value END) AS purchase, max(CASE WHEN event_type = 'view' THEN value END) AS view FROM events GROUP BY 1")
def _(t):
    return A.pivot_max(t.events, ["user_id"], "event_type", ["click", "purchase", "view"], "value")


@query("agg_12_weighted_mean", "SELECT l_suppkey, round(coalesce(sum(l_extendedprice * l_quantity) / nullif(sum(l_quantity), 0), avg(l_extendedprice)), 4) AS wmean FROM lineitem GROUP BY 1")
def _(t):
    return rounded(t.lineitem.groupBy("l_suppkey").agg(A.weighted_mean(c("l_extendedprice"), c("l_quantity")).alias("wmean")))


@query("agg_13_corr", "SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6) FROM lineitem UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6) FROM lineitem")
def _(t):
    return rounded(A.correlations(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]), 6)


@query("agg_14_duplicates", "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)) AS duplicates FROM lineitem")
def _(t):
    return A.duplicate_count(t.lineitem, ["l_orderkey", "l_suppkey"])


@query("agg_15_top_values", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def _(t):
    return A.top_values(t.events, "event_type")


@query("agg_16_bucket_stats", "SELECT p_size AS bucket, count(p_retailprice) AS n, round(avg(p_retailprice), 4) AS mean, round(stddev_samp(p_retailprice), 4) AS std FROM part GROUP BY 1")
def _(t):
    return rounded(A.bucket_stats(t.part, c("p_size"), "p_retailprice"))


# --- windows


@query("win_1_latest", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders) WHERE r = 1")
def _(t):
    return W.first_of(t.orders, ["o_custkey"], c("o_orderdate").desc(), c("o_orderkey")).select("o_custkey", "o_orderkey")


LEADERS = "SELECT year(o_orderdate) AS season, l_suppkey, round(sum(l_extendedprice), 2) AS pts, sum(l_quantity) AS reb FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2 HAVING count(*) >= 3"


@query("win_2_leaderboard", f"SELECT *, rank() OVER (PARTITION BY season ORDER BY pts DESC) AS pts_rank, rank() OVER (PARTITION BY season ORDER BY reb DESC) AS reb_rank FROM ({LEADERS})")
def _(t):
    s = lines(t).groupBy(order_year().alias("season"), "l_suppkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("pts"), F.sum("l_quantity").alias("reb"), F.count(F.lit(1)).alias("n")).filter("n >= 3").drop("n")
    return W.leaderboard(s, ["season"], ["pts", "reb"])


@query("win_3_rolling", "SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 7) AS o_totalprice_avg_5, round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 7) AS o_totalprice_avg_10 FROM orders")
def _(t):
    return rounded(W.trailing_mean(t.orders, ["o_custkey"], [c("o_orderdate"), c("o_orderkey")], "o_totalprice", [5, 10]).select("o_orderkey", "o_totalprice_avg_5", "o_totalprice_avg_10"), 7)


@query("win_4_rolling_before", "SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 7) AS o_totalprice_avg_20 FROM orders")
def _(t):
    return rounded(W.trailing_mean(t.orders, ["o_custkey"], [c("o_orderdate"), c("o_orderkey")], "o_totalprice", [20], current=False).select("o_orderkey", "o_totalprice_avg_20"), 7)


@query("win_7_dense_key", "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS game_sk FROM orders")
def _(t):
    return W.dense_key(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"], "game_sk").select("o_orderkey", c("game_sk").cast("long").alias("game_sk"))


ISLANDS = """s AS (SELECT user_id, event_type, ts, event_id, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS st FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
i AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM s)"""


def runs(t):
    return W.islands(t.events, ["user_id"], [c("ts"), c("event_id")], "event_type").groupBy("user_id", "island", "event_type").agg(F.count(F.lit(1)).alias("length"))


@query("win_8_islands", f"WITH {ISLANDS} SELECT user_id, CAST(island AS BIGINT) AS island, event_type, count(*) AS length FROM i GROUP BY 1, 2, 3")
def _(t):
    return runs(t)


@query("win_9_share", "SELECT l_orderkey, l_linenumber, round(l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_orderkey), 6) AS share FROM lineitem")
def _(t):
    return rounded(W.share(t.lineitem, ["l_orderkey"], "l_extendedprice", "share").select("l_orderkey", "l_linenumber", "share"), 6)


@query("win_10_percent_rank", "SELECT c_custkey, round((rank() OVER w + (count(*) OVER (PARTITION BY c_mktsegment, c_acctbal) - 1) / 2.0) / count(*) OVER (PARTITION BY c_mktsegment) * 100, 1) AS pct_rank, round((rank() OVER w - 1) / count(*) OVER (PARTITION BY c_mktsegment), 6) AS share_below FROM customer WINDOW w AS (PARTITION BY c_mktsegment ORDER BY c_acctbal)")
def _(t):
    return W.percent_ranks(t.customer, ["c_mktsegment"], "c_acctbal").select("c_custkey", "pct_rank", F.round("share_below", 6).alias("share_below"))


@query("win_11_z_score", "SELECT p_partkey, round(coalesce((p_retailprice - avg(p_retailprice) OVER w) / nullif(stddev_samp(p_retailprice) OVER w, 0), 0), 5) AS p_retailprice_z FROM part WINDOW w AS (PARTITION BY p_brand)")
def _(t):
    return rounded(W.z_scores(t.part, ["p_brand"], ["p_retailprice"]).select("p_partkey", "p_retailprice_z"), 5)


@query("win_12_centred_mean", "SELECT p_size, round(CASE WHEN count(m) OVER w = 5 THEN avg(m) OVER w END, 4) AS m_smooth FROM (SELECT p_size, avg(p_retailprice) AS m FROM part GROUP BY 1) WINDOW w AS (ORDER BY p_size ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)")
def _(t):
    curve = t.part.groupBy("p_size").agg(F.avg("p_retailprice").alias("m")).withColumn("all", F.lit(1))  # one row for each size
    return rounded(W.centred_mean(curve, ["all"], [c("p_size")], "m").select("p_size", "m_smooth"))


@query("win_13_date_gaps", "SELECT user_id, day, next_day, CAST(date_diff('day', day, next_day) AS INTEGER) AS gap_days FROM (SELECT user_id, day, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS next_day FROM (SELECT DISTINCT user_id, ts::DATE AS day FROM events)) WHERE date_diff('day', day, next_day) > 2")
def _(t):
    return W.date_gaps(t.events.withColumn("day", c("ts").cast("date")), ["user_id"], "day", 2)


@query("win_14_top_n", "SELECT p_brand, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS r FROM part) WHERE r <= 10")
def _(t):
    return W.first_of(t.part, ["p_brand"], c("p_retailprice").desc_nulls_last(), c("p_partkey"), n=10).select("p_brand", "p_partkey")


@query("win_15_rest_days", "SELECT o_orderkey, CAST(coalesce(date_diff('day', lag(o_orderdate::DATE) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate::DATE), 3) AS INTEGER) AS rest_days FROM orders")
def _(t):
    return W.days_since(t.orders.withColumn("day", c("o_orderdate").cast("date")), ["o_custkey"], "day", [c("o_orderdate"), c("o_orderkey")]).select("o_orderkey", "rest_days")


@query("win_16_sequence", "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS nth FROM orders")
def _(t):
    return t.orders.select("o_orderkey", F.row_number().over(W.by(["o_custkey"], c("o_orderdate"), c("o_orderkey"))).alias("nth"))


@query("win_17_running", "SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING), 2) AS o_totalprice_running FROM orders")
def _(t):
    return rounded(W.running_total(t.orders, ["o_custkey"], [c("o_orderdate"), c("o_orderkey")], "o_totalprice").select("o_orderkey", "o_totalprice_running"), 2)


@query("win_18_min_max", "SELECT c_custkey, round(coalesce((c_acctbal - min(c_acctbal) OVER w) * 100 / nullif(max(c_acctbal) OVER w - min(c_acctbal) OVER w, 0), 0), 4) AS c_acctbal_scaled FROM customer WINDOW w AS (PARTITION BY c_mktsegment)")
def _(t):
    return rounded(W.min_max(t.customer, ["c_mktsegment"], "c_acctbal", 100.0).select("c_custkey", "c_acctbal_scaled"))


# --- sorts, limits, sets


@query("srt_1_sorted", "SELECT n_name, n_regionkey FROM nation ORDER BY n_regionkey, n_name DESC")
def _(t):
    return t.nation.select("n_name", "n_regionkey").orderBy("n_regionkey", c("n_name").desc_nulls_last())


@query("srt_2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(t):
    return t.orders.orderBy(c("o_totalprice").desc_nulls_last(), "o_orderkey").limit(25).select("o_orderkey", "o_totalprice")


@query("srt_3_row_cap", "SELECT count(*) AS n FROM (SELECT * FROM lineitem LIMIT 10000)")
def _(t):
    from tipoff.plans.questions import capped

    return capped(t.lineitem, 50_000).agg(F.count(F.lit(1)).alias("n"))


@query("set_1_union_all", "SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region")
def _(t):
    return t.nation.select(c("n_name").alias("name")).union(t.region.select("r_name"))


@query("set_2_tagged_union", "SELECT c_name AS name, c_acctbal AS bal, c_mktsegment AS seg, 'customer' AS kind FROM customer UNION ALL SELECT s_name, s_acctbal, NULL, 'supplier' FROM supplier")
def _(t):
    return R.tagged_union({"customer": t.customer.select(c("c_name").alias("name"), c("c_acctbal").alias("bal"), c("c_mktsegment").alias("seg")), "supplier": t.supplier.select(c("s_name").alias("name"), c("s_acctbal").alias("bal"))}, "kind")


@query("set_3_diagonal", "SELECT 'nation' AS kind, CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(n_regionkey AS BIGINT) AS parent FROM nation UNION ALL SELECT 'region', r_regionkey, r_name, NULL FROM region")
def _(t):
    n, r = t.nation.toDF("id", "name", "parent"), t.region.toDF("id", "name")
    return R.stack_family({"nation": n, "region": r}, "kind", {"id": "long", "name": "string", "parent": "long"})


@query("set_4_except_all", "SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R' EXCEPT ALL SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'A'")
def _(t):
    return t.lineitem.filter("l_returnflag = 'R'").select("l_suppkey").exceptAll(t.lineitem.filter("l_returnflag = 'A'").select("l_suppkey"))


@query("set_5_recency_union", "SELECT o_orderkey, v FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY v DESC) AS r FROM (SELECT o_orderkey, 1 AS v FROM orders WHERE o_orderkey % 3 < 2 UNION ALL SELECT o_orderkey, 2 FROM orders WHERE o_orderkey % 3 > 0)) WHERE r = 1")
def _(t):
    o = t.orders.select("o_orderkey")
    both = o.filter("o_orderkey % 3 < 2").withColumn("v", F.lit(1)).unionByName(o.filter("o_orderkey % 3 > 0").withColumn("v", F.lit(2)))
    return W.first_of(both, ["o_orderkey"], c("v").desc())


@query("set_6_intersection", "SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'A' INTERSECT SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R'")
def _(t):
    return t.lineitem.filter("l_returnflag = 'A'").select("l_suppkey").intersect(t.lineitem.filter("l_returnflag = 'R'").select("l_suppkey"))


# --- reshaping


@query("rsh_1_unpivot", "SELECT l_orderkey, l_linenumber, 'qty' AS stat, l_quantity AS v FROM lineitem WHERE l_quantity IS NOT NULL UNION ALL SELECT l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem WHERE l_tax IS NOT NULL")
def _(t):
    return R.unpivot(t.lineitem, ["l_orderkey", "l_linenumber"], {"l_quantity": "qty", "l_tax": "tax"}, "stat", "v")


@query("rsh_2_slots", "SELECT l_orderkey, l_linenumber, 1 AS slot, l_partkey AS id FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 2, l_suppkey FROM lineitem")
def _(t):
    rows = F.array(F.struct(F.lit(1).alias("slot"), c("l_partkey").alias("id")), F.struct(F.lit(2).alias("slot"), c("l_suppkey").alias("id")))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.explode(rows).alias("r")).select("l_orderkey", "l_linenumber", "r.*")


@query("rsh_3_split_ids", "SELECT DISTINCT o_orderkey, TRY_CAST(trim(w) AS BIGINT) AS player_id, CAST(pos AS INTEGER) AS position FROM (SELECT o_orderkey, unnest(string_split(o_custkey || '-' || o_orderkey, '-')) AS w, unnest([1, 2]) AS pos FROM orders)")
def _(t):
    return R.split_ids(t.orders.withColumn("group_id", F.concat_ws("-", "o_custkey", "o_orderkey")), ["o_orderkey"], "group_id", "-", "player_id")


@query("rsh_4_metric_family", "SELECT 'qty' AS variant, l_suppkey, sum(l_quantity) AS stat_value FROM lineitem GROUP BY 2 UNION ALL SELECT 'lines', l_suppkey, CAST(count(*) AS DOUBLE) FROM lineitem GROUP BY 2")
def _(t):
    g = t.lineitem.groupBy("l_suppkey")
    return R.metric_family({"qty": g.agg(F.sum("l_quantity").alias("q")), "lines": g.agg(F.count(F.lit(1)).alias("n"))}, "variant", ["l_suppkey"])


@query("rsh_5_labelled_family", "SELECT 'A' AS detail, l_suppkey, sum(l_quantity) AS q, NULL::DOUBLE AS d FROM lineitem WHERE l_returnflag = 'A' GROUP BY 2 UNION ALL SELECT 'R', l_suppkey, NULL, round(sum(l_discount), 4) FROM lineitem WHERE l_returnflag = 'R' GROUP BY 2")
def _(t):
    a = t.lineitem.filter("l_returnflag = 'A'").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"))
    r = t.lineitem.filter("l_returnflag = 'R'").groupBy("l_suppkey").agg(F.round(F.sum("l_discount"), 4).alias("d"))
    return R.stack_family({"A": a, "R": r}, "detail", {"l_suppkey": "long", "q": "double", "d": "double"})


@query("rsh_6_pairs", "SELECT a.l_suppkey AS first_id, b.l_suppkey AS second_id, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) a JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey GROUP BY 1, 2")
def _(t):
    return R.pair_rows(t.lineitem, ["l_orderkey"], "l_suppkey", []).groupBy("first_id", "second_id").agg(F.count(F.lit(1)).alias("n"))


@query("rsh_7_flip", "SELECT o_orderkey, 'home' AS side, o_custkey AS team, o_totalprice AS margin FROM orders UNION ALL SELECT o_orderkey, 'away', -o_custkey, -o_totalprice FROM orders")
def _(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", (-c("o_custkey")).alias("opp"), (-c("o_totalprice")).alias("minus"))
    return R.flip(o, ["o_orderkey"], {"team": "o_custkey", "margin": "o_totalprice"}, {"team": "opp", "margin": "minus"})


@query("rsh_8_on_off", "SELECT a.s AS l_suppkey, a.q AS on_q, b.q AS off_q, a.q - b.q AS q_delta FROM (SELECT l_suppkey AS s, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1) a JOIN (SELECT l_suppkey AS s, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) b ON a.s = b.s")
def _(t):
    s = t.lineitem.groupBy("l_suppkey", F.concat(F.lit(" "), "l_returnflag").alias("f")).agg(F.sum("l_quantity").alias("q"))
    return R.on_off(s, ["l_suppkey"], "f", "A", "R", ["q"])


@query("rsh_9_baseline", "SELECT s.l_suppkey, s.l_returnflag, round(s.q / o.q, 6) AS share, s.n - o.n AS n_delta FROM (SELECT l_suppkey, l_returnflag, sum(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY 1, 2) s JOIN (SELECT l_suppkey, sum(l_quantity) AS q, count(*) AS n FROM lineitem GROUP BY 1) o ON s.l_suppkey = o.l_suppkey")
def _(t):
    s = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"))
    o = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("oq"), F.count(F.lit(1)).alias("on"))
    return s.join(o, "l_suppkey", "left").select("l_suppkey", "l_returnflag", F.round(S.ratio(c("q"), c("oq")), 6).alias("share"), (c("n") - c("on")).alias("n_delta"))


# --- scalar functions and metrics


@query("fn_1_strings", "SELECT p_partkey, split_part(p_name, ' ', 2) AS second, upper(trim(p_brand)) AS brand, left(p_type, 3) AS l3, lpad(CAST(p_size AS VARCHAR), 4, '0') AS size4, regexp_matches(p_type, 'STEEL|TIN') AS metal FROM part")
def _(t):
    return t.part.select("p_partkey", F.split_part("p_name", F.lit(" "), F.lit(2)).alias("second"), F.upper(F.trim("p_brand")).alias("brand"), F.left("p_type", F.lit(3)).alias("l3"), F.lpad(c("p_size").cast("string"), 4, "0").alias("size4"), c("p_type").rlike("STEEL|TIN").alias("metal"))


@query("fn_2_dates", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, strftime(o_orderdate, '%Y-%m-%d') AS iso, strftime(o_orderdate, '%A') AS dow, CAST(date_diff('day', DATE '1992-01-01', o_orderdate::DATE) AS INTEGER) AS n FROM orders")
def _(t):
    d = c("o_orderdate")
    return t.orders.select("o_orderkey", F.year(d).alias("y"), F.month(d).alias("m"), F.date_format(d, "yyyy-MM-dd").alias("iso"), F.date_format(d, "EEEE").alias("dow"), F.date_diff(d.cast("date"), F.lit("1992-01-01").cast("date")).alias("n"))


@query("fn_3_season_label", "SELECT o_orderkey, CASE WHEN month(o_orderdate) >= 10 THEN year(o_orderdate) || '-' || lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0') ELSE (year(o_orderdate) - 1) || '-' || lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0') END AS season FROM orders")
def _(t):
    return t.orders.select("o_orderkey", S.normal_season(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("season"))


@query("fn_4_math", "SELECT l_orderkey, l_linenumber, round(sqrt(l_quantity), 6) AS r, round(ln(l_extendedprice), 6) AS lg, l_orderkey % 7 AS m, nullif(l_linenumber, 1) AS n, l_returnflag IS DISTINCT FROM l_linestatus AS d FROM lineitem")
def _(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(F.sqrt("l_quantity"), 6).alias("r"), F.round(F.ln("l_extendedprice"), 6).alias("lg"), F.pmod("l_orderkey", F.lit(7)).alias("m"), F.nullif("l_linenumber", F.lit(1)).alias("n"), (~c("l_returnflag").eqNullSafe(c("l_linestatus"))).alias("d"))


@query("fn_5_keys", "SELECT count(DISTINCT p_brand || '|' || p_type) AS n_keys, count(*) AS n FROM part")
def _(t):
    k = t.part.select(S.text_key(c("p_brand"), c("p_type")).alias("k"))
    return k.agg(F.count_distinct("k").alias("n_keys"), F.count(F.lit(1)).alias("n"))


@query("fn_7_arrays", "SELECT p_partkey, CAST(i AS INTEGER) AS i, w FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, unnest(generate_series(1, len(string_split(p_name, ' ')))) AS i FROM part)")
def _(t):
    return t.part.select("p_partkey", F.posexplode(F.split("p_name", " ")).alias("i", "w")).select("p_partkey", (c("i") + 1).alias("i"), "w")


@query("fn_8_clock", "SELECT event_id, round(minute(ts) + second(ts) / 60.0, 6) AS minutes FROM events")
def _(t):
    return t.events.select("event_id", F.round(S.clock_minutes(F.date_format("ts", "mm:ss")), 6).alias("minutes"))


@query("fn_9_height", "SELECT p_partkey, p_size // 12 * 12 + p_size % 12 AS inches, CASE upper(left(p_type, 1)) WHEN 'G' THEN 'Guard' WHEN 'F' THEN 'Forward' WHEN 'C' THEN 'Center' ELSE 'Other' END AS pos FROM part")
def _(t):
    return t.part.select("p_partkey", S.height_inches(F.concat_ws("-", F.floor(c("p_size") / 12), c("p_size") % 12)).alias("inches"), S.position_group(c("p_type")).alias("pos"))


@query("fn_10_court", "SELECT l_orderkey, l_linenumber, l_quantity / 10 AS x, -l_extendedprice / 10 AS y FROM lineitem")
def _(t):
    x, y = S.court(c("l_extendedprice"), c("l_quantity"))
    return t.lineitem.select("l_orderkey", "l_linenumber", x.alias("x"), y.alias("y"))


@query("met_1_7_ratings", """SELECT l_orderkey, l_linenumber, round(CASE WHEN 2 * (q + 0.44 * n) = 0 THEN 0 ELSE q / (2 * (q + 0.44 * n)) END, 7) AS ts, round((q + 0.5 * n) / q, 8) AS efg,
round(CASE WHEN q - n + d + 0.44 * t = 0 THEN 0 ELSE 100 * p / (q - n + d + 0.44 * t) END, 4) AS ortg, round(q - n + d + 0.44 * t, 8) AS poss, round(100 * d / (q + 0.44 * t + d), 8) AS tov_pct FROM (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_linenumber AS n, l_extendedprice AS p, l_discount * 100 AS d, l_tax * 100 AS t FROM lineitem)""")
def _(t):
    q, n, p, d, x = c("l_quantity"), c("l_linenumber"), c("l_extendedprice"), c("l_discount") * 100, c("l_tax") * 100
    return rounded(t.lineitem.select("l_orderkey", "l_linenumber", F.round(M.true_shooting(q, q, n), 7).alias("ts"), M.effective_fg(q, n, q).alias("efg"), F.round(M.rating(p, M.possessions(q, x, n, d)), 4).alias("ortg"), M.possessions(q, x, n, d).alias("poss"), M.turnover_pct(d, q, x).alias("tov_pct")), 8, "efg", "poss", "tov_pct")


@query("met_3_16_shares", """SELECT l_orderkey, l_linenumber, round(100 * (q + 0.44 * n + 1) * (tq / 5) / (q * (tq + 0.44 * tn + 5)), 6) AS usage, round(48 * (q + tq) / (2 * (tq / 5)), 6) AS pace, round(100 * n * (tq / 5) / (q * (tn + 3)), 6) AS reb_pct, round(n / 1.0 / nullif(q, 0), 6) AS ast_tov,
round(100 * n * (tq / 5) / (q * 90), 6) AS stl_pct, round(n * 36 / q, 6) AS per36 FROM (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_linenumber AS n, sum(l_quantity) OVER (PARTITION BY l_orderkey) AS tq, sum(l_linenumber) OVER (PARTITION BY l_orderkey) AS tn FROM lineitem)""")
def _(t):
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey")
    d = t.lineitem.select("l_orderkey", "l_linenumber", c("l_quantity").alias("q"), c("l_linenumber").alias("n"), F.sum("l_quantity").over(w).alias("tq"), F.sum("l_linenumber").over(w).alias("tn"))
    q, n, tq, tn, one = c("q"), c("n"), c("tq"), c("tn"), F.lit(1)
    return rounded(d.select("l_orderkey", "l_linenumber", M.usage_rate(q, n, one, q, tq, tn, F.lit(5), tq).alias("usage"), M.pace(q, tq, tq).alias("pace"), M.rebound_pct(n, q, tq, tn, F.lit(3)).alias("reb_pct"), M.assist_to_turnover(n, q).alias("ast_tov"), M.steal_pct(n, q, tq, F.lit(90)).alias("stl_pct"), M.per_minutes(n, q).alias("per36")), 6)


@query("met_10_game_score", "SELECT l_orderkey, l_linenumber, round(l_extendedprice + 0.4 * l_quantity - 0.7 * l_quantity - 0.4 * (5 - 3) + 0.7 * l_linenumber + 0.3 * l_linenumber + 1 + 0.7 * l_linenumber + 0.7 - 0.4 * 2 - l_linenumber, 4) AS gs FROM lineitem")
def _(t):
    q, n, k = c("l_quantity"), c("l_linenumber"), F.lit
    return rounded(t.lineitem.select("l_orderkey", "l_linenumber", M.game_score(c("l_extendedprice"), q, q, k(3), k(5), n, n, k(1), n, k(1), k(2), n).alias("gs")))


@query("met_17_per_base", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 0 THEN round(l_tax * 36 / l_quantity, 2) ELSE 0 END AS l_tax_per36, CASE WHEN l_quantity > 0 THEN round(l_linenumber * 36 / l_quantity, 2) ELSE 0 END AS l_linenumber_per36 FROM lineitem")
def _(t):
    return M.per_base(t.lineitem, "l_quantity", ["l_tax", "l_linenumber"], 36.0, "per36").select("l_orderkey", "l_linenumber", "l_tax_per36", "l_linenumber_per36")
