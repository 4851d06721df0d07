"""Exact quantiles, profiles, significance, checks made from schemas, coverage and work plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from tipoff.operators import quality as Q
from tipoff.operators import selection
from tipoff.operators import significance as S
from tipoff.plans.catalogue import query, rounded

c = F.col


@query("agg_10_selected", "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 6) AS p25, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95, round(quantile_cont(l_extendedprice, 0.999), 6) AS p999 FROM lineitem GROUP BY 1")
def _(t):
    """By group, by selection over ranges: no task holds a group."""
    return rounded(selection.quantiles(t.lineitem, ["l_returnflag"], "l_extendedprice", {"p25": 0.25, "p50": 0.5, "p95": 0.95, "p999": 0.999}), 6)


@query("agg_10_selected_overall", "SELECT round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.95), 6) AS p95 FROM events")
def _(t):
    return rounded(selection.quantiles(t.events, [], "value", {"median": 0.5, "p95": 0.95}), 6)


#: Columns of the profiled tables: name, and whether it is numeric.
PROFILED = {
    "customer": {"c_custkey": True, "c_name": False, "c_nationkey": True, "c_acctbal": True, "c_mktsegment": False},
    "orders": {"o_orderkey": True, "o_custkey": True, "o_orderstatus": False, "o_totalprice": True, "o_orderdate": False, "o_orderpriority": False},
    "lineitem": {**dict.fromkeys(("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"), True), "l_returnflag": False, "l_linestatus": False, "l_shipdate": False},
    "labels": {"doc_id": True, "quality": True, "toxic": True},
}


def _profile_sql(table: str, col: str, numeric: bool) -> str:
    stats = f"CAST(min({col}) AS DOUBLE) AS min, CAST(max({col}) AS DOUBLE) AS max, round(quantile_cont(CAST({col} AS DOUBLE), 0.5), 6) AS p50, round(quantile_cont(CAST({col} AS DOUBLE), 0.95), 6) AS p95, NULL AS top"
    if not numeric:
        top = f"CASE WHEN count(DISTINCT {col}) <= 20 THEN (SELECT string_agg(v || '=' || n, ',' ORDER BY n DESC, v) FROM (SELECT CAST({col} AS VARCHAR) AS v, count(*) AS n FROM {table} WHERE {col} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 5)) END"
        stats = f"NULL AS min, NULL AS max, NULL AS p50, NULL AS p95, {top} AS top"
    return f"SELECT '{table}' AS \"table\", '{col}' AS \"column\", count(*) AS rows, count(*) - count({col}) AS nulls, count(DISTINCT {col}) AS \"distinct\", {stats} FROM {table}"


@query("dq_16_all_columns", " UNION ALL ".join(_profile_sql(n, col, num) for n, cols in PROFILED.items() for col, num in cols.items()))
def _(t):
    """Whole profiles of four tables."""
    out = None
    for name in PROFILED:
        one = rounded(selection.profile(getattr(t, name)), 6).select(F.lit(name).alias("table"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def _two(df):
    return df.select("test_used", F.round("statistic", 5).alias("statistic"), F.round("dof", 4).alias("dof"), F.round("p_value", 6).alias("p_value"), "significant", F.round("effect_size", 3).alias("effect_size"), "effect_label", F.round("mean_a", 3).alias("mean_a"), F.round("mean_b", 3).alias("mean_b"), "n_a", "n_b")


#: Tails by Simpson's rule, so that they are found in another way than the query finds them.
WELCH = """
WITH e AS (SELECT {group} AS g, {value} AS v FROM {table} WHERE {value} IS NOT NULL),
m AS (SELECT count(*) FILTER (WHERE g = {a}) AS na, count(*) FILTER (WHERE g = {b}) AS nb, avg(v) FILTER (WHERE g = {a}) AS ma, avg(v) FILTER (WHERE g = {b}) AS mb, var_samp(v) FILTER (WHERE g = {a}) AS va, var_samp(v) FILTER (WHERE g = {b}) AS vb FROM e),
s AS (SELECT *, (ma - mb) / sqrt(va / na + vb / nb) AS t, pow(va / na + vb / nb, 2) / (pow(va / na, 2) / (na - 1) + pow(vb / nb, 2) / (nb - 1)) AS dof, abs(ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)) AS d FROM m),
w AS (SELECT *, atan(abs(t) / sqrt(dof)) AS th, (pi() / 2 - atan(abs(t) / sqrt(dof))) / 20000 AS h FROM s),
p AS (SELECT *, 2 * exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(pi()) * h / 3 * list_sum(list_transform(range(0, 20001), lambda k: (CASE WHEN k IN (0, 20000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * pow(abs(cos(th + k * h)), dof - 1))) AS p FROM w),
r AS (SELECT g, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk FROM e WHERE g IN ({a}, {b})),
ties AS (SELECT sum(pow(n, 3) - n) AS ties FROM (SELECT count(*) AS n FROM e WHERE g IN ({a}, {b}) GROUP BY v)),
u AS (SELECT (SELECT sum(rk) FROM r WHERE g = {a}) - na * (na + 1) / 2.0 AS u, ties, m.* FROM m, ties),
z AS (SELECT *, (greatest(u, na * nb - u) - na * nb / 2.0 - 0.5) / sqrt(na * nb / 12.0 * (na + nb + 1 - ties / ((na + nb) * (na + nb - 1.0)))) AS z FROM u),
q AS (SELECT *, least(1, 2 * list_sum(list_transform(range(0, 20001), lambda k: (CASE WHEN k IN (0, 20000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * exp(-pow(z + k * 14.0 / 20000, 2) / 2))) * (14.0 / 20000) / 3 / sqrt(2 * pi())) AS p FROM z),
pair AS (SELECT 'Welch''s t-test' AS test_used, t AS statistic, dof, p, d, ma, mb, na, nb FROM p UNION ALL SELECT 'Mann-Whitney U', q.u, NULL, q.p, p.d, q.ma, q.mb, q.na, q.nb FROM q, p)
SELECT test_used, round(statistic, 5) AS statistic, round(dof, 4) AS dof, round(p, 6) AS p_value, p < 0.05 AS significant, round(d, 3) AS effect_size, CASE WHEN d < 0.2 THEN 'negligible' WHEN d < 0.5 THEN 'small' WHEN d < 0.8 THEN 'medium' ELSE 'large' END AS effect_label,
round(ma, 3) AS mean_a, round(mb, 3) AS mean_b, na AS n_a, nb AS n_b FROM pair
"""


@query("an_5_significance", WELCH.format(table="events", group="event_type", value="value", a="'click'", b="'view'"))
def _(t):
    """Both tests of one difference, with p-values, labels and verdicts."""
    return _two(S.difference(t.events, "event_type", "click", "view", "value").unionByName(S.difference(t.events, "event_type", "click", "view", "value", S.RANKS)))


@query("an_5_significance_ties", WELCH.format(table="lineitem", group="l_returnflag", value="l_quantity", a="'A'", b="'N'"))
def _(t):
    """Values that many rows share: the tie correction counts."""
    return _two(S.difference(t.lineitem, "l_returnflag", "A", "N", "l_quantity").unionByName(S.difference(t.lineitem, "l_returnflag", "A", "N", "l_quantity", S.RANKS)))


def _streak_sql(target: int, direction: str) -> str:
    return f"""
WITH o AS (SELECT user_id, ts, event_id, CASE WHEN value > 50 THEN 1 ELSE 0 END AS w FROM events), s AS (SELECT *, CASE WHEN lag(w) OVER (PARTITION BY user_id ORDER BY ts, event_id) = w THEN 0 ELSE 1 END AS st FROM o),
i AS (SELECT *, sum(st) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g FROM s), r AS (SELECT user_id, g, w, count(*) AS len FROM i GROUP BY 1, 2, 3),
k AS (SELECT user_id, max(CASE WHEN w = {target} THEN len ELSE 0 END) AS longest, CAST(count(*) AS DOUBLE) AS runs, CAST(sum(len * w) AS DOUBLE) AS a, CAST(sum(len * (1 - w)) AS DOUBLE) AS b, CAST(sum(len) AS DOUBLE) AS n FROM r GROUP BY 1),
v AS (SELECT *, (CASE WHEN {target} = 1 THEN a ELSE b END) / n AS share, 1 + 2 * a * b / n AS mean, CASE WHEN n > 1 THEN 2 * a * b * (2 * a * b - n) / (n * n * (n - 1)) END AS var FROM k),
z AS (SELECT *, CASE WHEN n >= 10 AND a > 0 AND b > 0 AND var > 0 THEN abs(runs - mean) / sqrt(var) END AS z FROM v),
p AS (SELECT *, CASE WHEN z IS NOT NULL THEN 2 * list_sum(list_transform(range(0, 2001), lambda k: (CASE WHEN k IN (0, 2000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * exp(-pow(z + k * 12.0 / 2000, 2) / 2))) * (12.0 / 2000) / 3 / sqrt(2 * pi()) END AS p FROM z)
SELECT user_id, '{direction}' AS direction, CAST(longest AS BIGINT) AS longest, round(CASE WHEN share > 0 AND share < 1 THEN ln(n) / -ln(share) WHEN share = 1 THEN n ELSE 0 END, 1) AS expected_longest, CAST(n AS BIGINT) AS n, round(a / n, 4) AS success_rate, CAST(runs AS BIGINT) AS runs, round(p, 6) AS p_value, p < 0.05 AS significant FROM p"""


@query("an_6_significance", f"SELECT * FROM ({_streak_sql(1, 'hot')}) UNION ALL SELECT * FROM ({_streak_sql(0, 'cold')})")
def _(t):
    """Every user's hot and cold streaks."""
    e, out = t.events.withColumn("w", F.when(c("value") > 50, 1).otherwise(0)), None
    for d in ("hot", "cold"):
        s = S.streaks(e, ["user_id"], [c("ts"), c("event_id")], "w", d)
        one = s.select("user_id", F.lit(d).alias("direction"), c("longest").cast("long").alias("longest"), F.round("expected_longest", 1).alias("expected_longest"), "n", F.round("success_rate", 4).alias("success_rate"), "runs", F.round("p_value", 6).alias("p_value"), "significant")
        out = one if out is None else out.unionByName(one)
    return out


#: The checked tables: critical columns, inferred key and the statistics of fact tables, as the rules find them.
CHECKED = {
    "region": ([], ["r_regionkey"], []), "nation": (["n_regionkey"], ["n_nationkey", "n_regionkey"], []), "customer": (["c_custkey"], ["c_custkey", "c_nationkey"], []), "supplier": (["s_suppkey"], ["s_suppkey", "s_nationkey"], []), "part": (["p_partkey"], ["p_partkey"], []),
    "orders": (["o_custkey", "o_orderkey"], ["o_orderkey", "o_custkey"], []), "lineitem": (["l_orderkey", "l_partkey", "l_suppkey"], ["l_orderkey", "l_partkey", "l_suppkey"], ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
    "events": (["event_id", "user_id"], ["event_id", "user_id"], []), "documents": (["doc_id"], ["doc_id"], []), "embeddings": (["vec_id"], ["vec_id"], []), "pages": ([], ["page_id"], []), "benchmark": ([], ["item_id"], []), "labels": (["doc_id"], ["doc_id"], []), "conversations": (["conv_id"], ["conv_id"], []),
}


def _checks_sql() -> str:
    out = []
    for name, (critical, keys, stats) in CHECKED.items():
        of = lambda check, cols, n, severity, name=name: f"SELECT '{name}' AS \"table\", '{check}' AS \"check\", '{cols}' AS columns, n, total, {severity} AS severity FROM (SELECT {n} AS n, count(*) AS total FROM {name})"
        out += [of("null_key_column", k, f"count(*) - count({k})", "CASE WHEN n > 0.01 * total THEN 'error' WHEN n > 0 THEN 'warning' END") for k in critical]
        out.append(of("duplicate_keys", ",".join(keys), f"count(*) - count(DISTINCT ({', '.join(keys)}))" if len(keys) > 1 else f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {keys[0]} FROM {name}))", "CASE WHEN n > 0 THEN 'warning' END"))
        if stats:
            out.append(of("zero_stat_rows", ",".join(stats), f"count(*) FILTER (WHERE {' AND '.join(f'coalesce({k}, 0) = 0' for k in stats)})", "CASE WHEN n > 0.05 * total THEN 'info' END"))
    return " UNION ALL ".join(out)


@query("dq_15_schema", _checks_sql())
def _(t):
    """Checks that the schemas of all 14 tables give: keys by name, one aggregation a table."""
    return Q.schema_checks({n: getattr(t, n) for n in CHECKED}, {k for critical, _, _ in CHECKED.values() for k in critical}, {"lineitem", "orders", "events"}, suffixes=("_id", "key"))


@query("dq_19_coverage", """
WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS season, o_orderpriority AS type FROM orders),
x AS (SELECT 'orders' AS tab, 'orders' AS ep, season, type, TRUE AS staged FROM y UNION ALL SELECT DISTINCT 'orders', 'orders', season, NULL, TRUE FROM y UNION ALL SELECT 'lineitem', 'lines', season, type, TRUE FROM y
  UNION ALL SELECT 'customer', 'orders', season, type, TRUE FROM y UNION ALL SELECT 'gone', 'orders', season, type, type <> '5-LOW' FROM y UNION ALL SELECT 'events', 'events', season, type, TRUE FROM y),
a AS (SELECT 'orders' AS tab, CAST(year(o_orderdate) AS VARCHAR) AS season, o_orderpriority AS type, count(*) AS n FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED' GROUP BY ALL UNION ALL SELECT 'lineitem', CAST(year(l_shipdate) AS VARCHAR), NULL, count(*) FROM lineitem WHERE year(l_shipdate) < 1998 GROUP BY ALL),
l AS (SELECT CAST(year(o_orderdate) AS VARCHAR) AS season, o_orderpriority AS type, o_custkey, max_by(o_orderstatus, o_orderkey) AS st FROM orders WHERE NOT (year(o_orderdate) = 1996 AND o_orderpriority = '2-HIGH') GROUP BY ALL),
j AS (SELECT season, type, count(*) FILTER (WHERE st = 'F') AS done, count(*) FILTER (WHERE st = 'O') AS failed, count(*) FILTER (WHERE st = 'P') AS running FROM l GROUP BY ALL),
js AS (SELECT season, sum(done) AS done, sum(failed) AS failed, sum(running) AS running FROM j GROUP BY ALL),
t AS (SELECT 'orders' AS tab, TRUE AS has_season, TRUE AS has_type, (SELECT count(*) FROM orders) AS n UNION ALL SELECT 'lineitem', TRUE, FALSE, (SELECT count(*) FROM lineitem) UNION ALL SELECT 'customer', FALSE, FALSE, (SELECT count(*) FROM customer) UNION ALL SELECT 'events', TRUE, FALSE, (SELECT count(*) FROM events)),
r AS (SELECT x.*, t.tab IS NOT NULL AS there, has_season, has_type, t.n AS table_rows, coalesce((SELECT sum(n) FROM a WHERE a.tab = x.tab AND a.season = x.season), 0) AS s_rows, coalesce((SELECT sum(n) FROM a WHERE a.tab = x.tab AND a.season = x.season AND a.type = x.type), 0) AS x_rows,
  CASE WHEN ep <> 'orders' THEN 0 WHEN j.season IS NOT NULL THEN j.done ELSE coalesce(js.done, 0) END AS done, CASE WHEN ep <> 'orders' THEN 0 WHEN j.season IS NOT NULL THEN j.failed ELSE coalesce(js.failed, 0) END AS failed, CASE WHEN ep <> 'orders' THEN 0 WHEN j.season IS NOT NULL THEN j.running ELSE coalesce(js.running, 0) END AS running
  FROM x LEFT JOIN t ON x.tab = t.tab LEFT JOIN j ON x.season = j.season AND x.type = j.type LEFT JOIN js ON js.season = x.season),
f AS (SELECT *, CASE WHEN type IS NULL THEN s_rows ELSE x_rows END AS own, CASE WHEN NOT staged THEN 'contract_gap' WHEN NOT there THEN 'missing_table' WHEN (CASE WHEN type IS NULL THEN s_rows ELSE x_rows END) > 0 THEN 'present' WHEN type IS NOT NULL AND NOT has_type AND s_rows > 0 THEN 'present_untyped'
  WHEN NOT has_season AND table_rows > 0 AND done > 0 THEN 'present_inferred' WHEN done > 0 THEN 'empty_valid' WHEN failed > 0 THEN 'failed' WHEN running > 0 THEN 'running' ELSE 'missing' END AS status FROM r)
SELECT tab AS "table", season, type, status, CAST(CASE status WHEN 'present_untyped' THEN s_rows WHEN 'present_inferred' THEN done + failed + running ELSE own END AS BIGINT) AS rows FROM f""")
def _(t):
    """Five expected tables by season and type: typed, without types, without seasons, one that isn't there, one that is empty; journal entries are the customers' last orders."""
    o = t.orders.select(F.year("o_orderdate").cast("string").alias("season"), c("o_orderpriority").alias("type"), "o_custkey", "o_orderkey", "o_orderstatus")
    y = o.select("season", "type").distinct()
    want = lambda table, endpoint, rows, staged=None: rows.select(F.lit(table).alias("table"), F.lit(endpoint).alias("endpoint"), "season", "type", (staged if staged is not None else F.lit(True)).alias("staged"))
    seasons = y.select("season", F.lit(None).cast("string").alias("type")).distinct()
    expected = want("orders", "orders", y).unionByName(want("orders", "orders", seasons)).unionByName(want("lineitem", "lines", y)).unionByName(want("customer", "orders", y)).unionByName(want("gone", "orders", y, c("type") != "5-LOW")).unionByName(want("events", "events", y))
    count = F.count(F.lit(1)).alias("rows")
    a = o.filter("type <> '4-NOT SPECIFIED'").groupBy(F.lit("orders").alias("table"), "season", "type").agg(count)
    b = t.lineitem.filter(F.year("l_shipdate") < 1998).groupBy(F.lit("lineitem").alias("table"), F.year("l_shipdate").cast("string").alias("season"), F.lit(None).cast("string").alias("type")).agg(count)
    status = F.when(c("o_orderstatus") == "F", "done").when(c("o_orderstatus") == "O", "failed").otherwise("running")
    journal = o.filter("not (season = '1996' and type = '2-HIGH')").select(F.lit("orders").alias("endpoint"), "season", "type", c("o_custkey").alias("item"), c("o_orderkey").alias("attempt"), status.alias("status"), F.lit(1).alias("rows"))
    tables = None
    for name, has_season, has_type in (("orders", True, True), ("lineitem", True, False), ("customer", False, False), ("events", True, False)):
        one = getattr(t, name).agg(count).select(F.lit(name).alias("table"), F.lit(has_season).alias("has_season"), F.lit(has_type).alias("has_type"), "rows")
        tables = one if tables is None else tables.unionByName(one)
    return Q.coverage_status(expected, a.unionByName(b), journal, tables).select("table", "season", "type", "status", c("rows").cast("long").alias("rows"))


@query("dq_21_plan", """
WITH p AS (SELECT DISTINCT l_suppkey, year(l_shipdate) AS y, l_returnflag AS k FROM lineitem), s AS (SELECT l_suppkey, y, string_agg(k, ',' ORDER BY k) AS types, count(*) AS n FROM p GROUP BY 1, 2),
g AS (SELECT l_suppkey, types, string_agg(CAST(y AS VARCHAR), ',' ORDER BY y) AS seasons, CAST(sum(n) AS BIGINT) AS load FROM s GROUP BY 1, 2),
o AS (SELECT l_suppkey, row_number() OVER (ORDER BY sum(load) DESC, l_suppkey) - 1 AS k FROM g GROUP BY 1)
SELECT g.*, CAST(CASE WHEN k // 4 % 2 = 0 THEN k % 4 ELSE 3 - k % 4 END AS INTEGER) AS shard FROM g JOIN o USING (l_suppkey)""")
def _(t):
    p = t.lineitem.select("l_suppkey", F.year("l_shipdate").alias("y"), c("l_returnflag").alias("k"))
    return Q.work_plan(p, "l_suppkey", "y", "k", 4).select("l_suppkey", "types", "seasons", "load", "shard")
