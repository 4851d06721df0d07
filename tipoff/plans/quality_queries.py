"""Sinks, data quality, coverage, streaming-style and pipeline queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tipoff.operators import joins as J
from tipoff.operators import quality as Q
from tipoff.operators import windows as W
from tipoff.plans.catalogue import query, rounded
from tipoff.sources import sinks

c = F.col


def order_year():
    return F.year("o_orderdate")


@query("snk_1_partitioned_parquet", "SELECT CAST(year(l_shipdate) AS INTEGER) AS season_year, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1")
def _(t):
    path = sinks.work_dir(t.spark) + "/lineitem"
    sinks.write_parquet(t.lineitem.withColumn("season_year", F.year("l_shipdate")), path, "season_year")
    return t.spark.read.parquet(path).groupBy("season_year").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))


@query("snk_2_csv", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def _(t):
    path = sinks.work_dir(t.spark) + "/csv"
    cols = t.customer.select("c_custkey", "c_name", "c_nationkey")
    sinks.write_csv(cols, path)
    return t.spark.read.schema(cols.schema).option("header", True).csv(path)


@query("snk_3_table", "SELECT n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey, n_name FROM nation")
def _(t):
    name = "tipoff_" + sinks.work_dir(t.spark)[-8:].replace("-", "_").replace("/", "_")
    df = t.nation.select("n_nationkey", "n_name")
    sinks.write_table(df, name)
    sinks.write_table(df, name, append=True)
    return t.spark.table(name)


@query("snk_5_export", "SELECT 'customer' AS name, 'parquet' AS format, count(*) AS n FROM customer UNION ALL SELECT 'customer', 'csv', count(*) FROM customer UNION ALL SELECT 'orders', 'parquet', count(*) FROM orders UNION ALL SELECT 'orders', 'csv', count(*) FROM orders")
def _(t):
    base, out = sinks.work_dir(t.spark), None
    for name in ("customer", "orders"):
        p, v = f"{base}/{name}.p", f"{base}/{name}.c"
        sinks.fan_out(getattr(t, name), {"parquet": lambda d, p=p: sinks.write_parquet(d, p), "csv": lambda d, v=v: sinks.write_csv(d, v)}, strict=True)
        for fmt, df in (("parquet", t.spark.read.parquet(p)), ("csv", t.spark.read.option("header", True).csv(v))):
            one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), F.lit(fmt).alias("format"), "n")
            out = one if out is None else out.unionByName(one)
    return out


@query("snk_6_append_new", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 4 IN (0, 1, 2, 3) AND NOT (o_orderkey % 4 < 2)")
def _(t):
    o = t.orders.select("o_orderkey", "o_totalprice")
    return sinks.new_rows(o, o.filter("o_orderkey % 4 < 2"))


@query("snk_7_8_chunks", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_linenumber <= 3")
def _(t):
    store = sinks.ChunkStore(t.spark, sinks.work_dir(t.spark))
    for k in (1, 2, 3, 2):
        store.append(f"line-{k}", t.lineitem.filter(c("l_linenumber") == k).select("l_orderkey", "l_linenumber", "l_quantity"))
    return store.materialize().select("l_orderkey", "l_linenumber", "l_quantity")


@query("snk_7_8_chunks_all", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def _(t):
    store = sinks.ChunkStore(t.spark, sinks.work_dir(t.spark))
    known = [r[0] for r in t.lineitem.select("l_linenumber").distinct().orderBy("l_linenumber").collect()]  # a row for each line number
    for k in [*known, *known[:1]]:  # the first once more: a replay
        store.append(f"line-{k}", t.lineitem.filter(c("l_linenumber").eqNullSafe(F.lit(k))).select("l_orderkey", "l_linenumber", "l_quantity"))
    return store.materialize().select("l_orderkey", "l_linenumber", "l_quantity")


@query("snk_9_manifest", "SELECT 'nation' AS \"table\", count(*) AS rows FROM nation UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part")
def _(t):
    return sinks.manifest({n: getattr(t, n) for n in ("nation", "orders", "part")}).select("table", "rows")


@query("src_2_envelopes", "SELECT n_nationkey AS nation_id, n_name AS nation_name FROM nation")
def _(t):
    from tipoff.sources.payloads import read_envelopes

    path = sinks.work_dir(t.spark) + "/envelopes"
    rows = F.transform(F.collect_list(F.struct("n_nationkey", "n_name")), lambda r: F.array(r["n_nationkey"].cast("string"), r["n_name"]))
    one = F.struct(F.lit("Nations").alias("name"), F.array(F.lit("NATION_ID"), F.lit("nationName")).alias("headers"), rows.alias("rowSet"))
    t.nation.groupBy("n_regionkey").agg(F.array(one).alias("resultSets")).select("resultSets").write.json(path)  # one envelope for each region
    return read_envelopes(t.spark, path, {"Nations": ["NATION_ID", "nationName"]}, {"nation_id": "int"}, multi_line=False)["Nations"]


@query("src_5_discover")
def _(t):
    from tipoff.sources.payloads import discover_sets

    nested = t.orders.join(t.lineitem, c("o_orderkey") == c("l_orderkey")).groupBy("o_orderkey").agg(F.collect_list("l_suppkey").alias("ids")).select(F.to_json(F.struct(F.struct("ids").alias("game"))).alias("j"))
    return discover_sets(nested, "j").groupBy("path").agg(F.count(F.lit(1)).alias("n"))


@query("dq_1_anomalies", "WITH d AS (SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY 1), s AS (SELECT avg(n) AS m, stddev_samp(n) AS sd FROM d) SELECT day, n, round((n - m) / nullif(sd, 0), 6) AS z, CASE WHEN coalesce(sd, 0) = 0 THEN n <> m ELSE abs((n - m) / sd) > 2 END AS anomaly FROM d, s")
def _(t):
    d = t.events.groupBy(c("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return rounded(Q.count_anomalies(d, "day", "n", 2.0), 6)


@query("dq_3_null_rates", "SELECT 'event_type' AS \"column\", count(*) FILTER (WHERE event_type IS NULL) / count(*) AS null_rate FROM events UNION ALL SELECT 'props', count(*) FILTER (WHERE props IS NULL) / count(*) FROM events")
def _(t):
    return Q.null_rates(t.events, ["event_type", "props"])


@query("dq_4_unique", "SELECT count(*) - count(DISTINCT o_orderkey) AS duplicates FROM orders")
def _(t):
    from tipoff.operators.aggregates import duplicate_count

    return duplicate_count(t.orders, ["o_orderkey"])


@query("dq_5_references", "SELECT count(*) AS orphans FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def _(t):
    return J.orphans(t.lineitem, "l_orderkey", t.orders, "o_orderkey").agg(F.count(F.lit(1)).alias("orphans"))


@query("dq_6_distinct_bounds", "SELECT count(DISTINCT l_returnflag) AS n, count(DISTINCT l_returnflag) BETWEEN 2 AND 5 AS ok FROM lineitem")
def _(t):
    return t.lineitem.agg(F.count_distinct("l_returnflag").alias("n"), F.count_distinct("l_returnflag").between(2, 5).alias("ok"))


@query("dq_7_sum_tolerance", "SELECT abs(a.s - b.s) <= 0.01 * abs(a.s) AS ok, a.s AS left_sum FROM (SELECT sum(l_quantity) AS s FROM lineitem) a, (SELECT sum(q) AS s FROM (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1)) b")
def _(t):
    a = t.lineitem.agg(F.sum("l_quantity").alias("left_sum"))
    b = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("q")).agg(F.sum("q").alias("s"))
    return a.crossJoin(b).select((F.abs(c("left_sum") - c("s")) <= 0.01 * F.abs("left_sum")).alias("ok"), "left_sum")


@query("dq_8_range_and_rules", "SELECT count(*) FILTER (WHERE NOT (l_quantity BETWEEN 1 AND 50)) AS bad_quantity, count(*) FILTER (WHERE l_discount > 0.05) AS big_discount FROM lineitem")
def _(t):
    return Q.violations(t.lineitem, {"bad_quantity": c("l_quantity").between(1, 50), "big_discount": c("l_discount") <= 0.05})


@query("dq_12_coverage", "SELECT count(*) AS expected, count(*) FILTER (WHERE l.doc_id IS NULL) AS missing, count(*) FILTER (WHERE l.doc_id IS NULL) > 0.1 * count(*) AS error FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id")
def _(t):
    return Q.coverage(t.documents, t.labels, ["doc_id"])


@query("dq_13_parity", "SELECT count(*) AS source_rows, count(*) AS output_rows, TRUE AS ok FROM orders")
def _(t):
    a, b = t.orders.agg(F.count(F.lit(1)).alias("source_rows")), t.orders.select("o_orderkey").agg(F.count(F.lit(1)).alias("output_rows"))
    return a.crossJoin(b).withColumn("ok", c("source_rows") == c("output_rows"))


@query("dq_14_low_counts", "WITH n AS (SELECT year(o_orderdate) AS year, count(*) AS games FROM orders GROUP BY 1), m AS (SELECT list_sort(list(games))[len(list(games)) // 2 + 1] AS med FROM n) SELECT year, games FROM n, m WHERE games < 0.9 * med")
def _(t):
    return Q.low_counts(t.orders.groupBy(order_year().alias("year")).agg(F.count(F.lit(1)).alias("games")), "games", 0.9)


@query("dq_15_keys", "SELECT count(*) FILTER (WHERE l_orderkey IS NULL) AS null_keys, count(*) FILTER (WHERE l_quantity = 0 AND l_tax = 0) AS zero_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicates FROM lineitem")
def _(t):
    d = F.count(F.lit(1)) - F.count_distinct(F.struct("l_orderkey", "l_linenumber"))
    return t.lineitem.agg(F.count_if(c("l_orderkey").isNull()).alias("null_keys"), F.count_if((c("l_quantity") == 0) & (c("l_tax") == 0)).alias("zero_rows"), d.alias("duplicates"))


@query("dq_16_profile", "SELECT 'c_acctbal' AS \"column\", count(*) AS rows, CAST(0 AS DOUBLE) AS null_share, count(DISTINCT c_acctbal) AS \"distinct\", min(c_acctbal) AS min, max(c_acctbal) AS max, round(quantile_cont(c_acctbal, 0.5), 6) AS p50, round(quantile_cont(c_acctbal, 0.95), 6) AS p95 FROM customer")
def _(t):
    return rounded(Q.profile(t.customer, ["c_acctbal"]), 6)


@query("dq_17_matrix", "SELECT 'orders' AS name, year(o_orderdate) AS season, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'lineitem', year(l_shipdate), count(*) FROM lineitem GROUP BY 2")
def _(t):
    a = t.orders.groupBy(order_year().alias("season")).agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit("orders"))
    return a.unionByName(t.lineitem.groupBy(F.year("l_shipdate").alias("season")).agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit("lineitem")))


@query("dq_18_journal", "SELECT event_type, json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1, 2")
def _(t):
    return t.events.groupBy("event_type", F.get_json_object("props", "$.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query("dq_19_status", """SELECT coverage, count(*) AS n FROM (SELECT CASE WHEN l.doc_id IS NOT NULL AND q = 1 THEN 'complete' WHEN l.doc_id IS NOT NULL THEN 'present_after_failure' ELSE 'missing' END AS coverage
FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS q FROM labels GROUP BY 1) l ON d.doc_id = l.doc_id) GROUP BY 1""")
def _(t):
    j = t.labels.select("doc_id", F.when(c("quality") == 1, "done").otherwise("failed").alias("status"))
    return Q.status_matrix(t.documents, t.labels.select("doc_id", F.lit(1).alias("rows")), j, ["doc_id"]).groupBy("coverage").agg(F.count(F.lit(1)).alias("n"))


@query("dq_20_gaps", "SELECT c_custkey, y FROM customer, (SELECT DISTINCT year(o_orderdate) AS y FROM orders) EXCEPT SELECT o_custkey, year(o_orderdate) FROM orders")
def _(t):
    years = t.orders.select(order_year().alias("y")).distinct().agg(F.collect_set("y").alias("ys"))  # a few seasons
    grid = t.customer.select("c_custkey").join(F.broadcast(years)).select("c_custkey", F.explode("ys").alias("y"))
    return Q.gaps(grid, t.orders.select(c("o_custkey").alias("c_custkey"), order_year().alias("y")), ["c_custkey", "y"])


@query("dq_21_workload", "SELECT DISTINCT l_suppkey, year(l_shipdate) AS season, l_suppkey % 4 AS shard FROM lineitem")
def _(t):
    return t.lineitem.select("l_suppkey", F.year("l_shipdate").alias("season"), F.pmod("l_suppkey", F.lit(4)).alias("shard")).distinct()


@query("dq_22_grid", "SELECT y, s FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders), (SELECT DISTINCT o_orderstatus AS s FROM orders) WHERE NOT (s = 'P' AND y < 1995)")
def _(t):
    kinds = t.orders.select("o_orderstatus").distinct().agg(F.collect_set("o_orderstatus").alias("ss"))  # a few kinds
    g = t.orders.select(order_year().alias("y")).distinct().join(F.broadcast(kinds)).select("y", F.explode("ss").alias("s"))
    return g.filter(~((c("s") == "P") & (c("y") < 1995)))


@query("dq_23_summary", "SELECT event_type, count(*) AS n, count(*) FILTER (WHERE value > 50) AS n_big FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(c("value") > 50).alias("n_big"))


@query("dq_9_10_11_gate", "SELECT name, n, n > 0 AS ok FROM (SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'region', count(*) FROM region)")
def _(t):
    from tipoff.operators.reshape import tagged_union

    n = {k: getattr(t, k).agg(F.count(F.lit(1)).alias("n")) for k in ("customer", "orders", "region")}
    return tagged_union(n, "name").select("name", "n", (c("n") > 0).alias("ok"))


@query("str_1_snapshots", "SELECT DISTINCT event_id, user_id, event_type FROM events WHERE event_type <> 'error'")
def _(t):
    from tipoff.streaming.snapshots import replay_snapshots

    base = sinks.work_dir(t.spark)
    e = t.events.filter("event_type <> 'error'").select("event_id", "user_id", "event_type")
    e.withColumn("b", F.pmod("event_id", F.lit(3))).write.partitionBy("b").parquet(f"{base}/landing")
    replay_snapshots(t.spark, f"{base}/landing", f"{base}/out", f"{base}/state", ["event_id"], "events", e.schema)
    replay_snapshots(t.spark, f"{base}/landing", f"{base}/out", f"{base}/state", ["event_id"], "events", e.schema)
    return t.spark.read.parquet(f"{base}/out").select("event_id", "user_id", "event_type")


@query("str_3_marks", "SELECT event_type AS name, max(event_id) AS mark, count(*) AS n FROM events GROUP BY 1")
def _(t):
    from tipoff.streaming.snapshots import merge_marks

    a = t.events.filter("event_id % 2 = 0").groupBy(c("event_type").alias("name")).agg(F.max("event_id").alias("mark"), F.count(F.lit(1)).alias("n"))
    b = t.events.filter("event_id % 2 = 1").groupBy(c("event_type").alias("name")).agg(F.max("event_id").alias("mark"), F.count(F.lit(1)).alias("n"))
    return merge_marks(a, b, ["name"])


@query("str_4_incremental", "SELECT year(o_orderdate) AS y, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def _(t):
    from tipoff.streaming.snapshots import refresh_partitions

    path = sinks.work_dir(t.spark) + "/orders"
    o = t.orders.withColumn("y", order_year())
    sinks.write_parquet(o.filter("y < 1997 or o_orderkey % 2 = 0"), path, "y")
    refresh_partitions(o.filter("y >= 1997"), path, "y")
    return t.spark.read.parquet(path).groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("str_5_attempts", "SELECT user_id, CASE WHEN n_err > 5 THEN 'abandoned' WHEN last_type = 'error' THEN 'failed' ELSE 'done' END AS status, least(n_err, 5) AS retries FROM (SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS n_err, max_by(event_type, event_id) AS last_type FROM events GROUP BY 1)")
def _(t):
    from tipoff.streaming.snapshots import attempt_status

    return attempt_status(t.events, ["user_id"], "event_id", c("event_type") == "error", 5)


@query("pl_1_model_run", "SELECT l_suppkey, season, pts, rank() OVER (PARTITION BY season ORDER BY pts DESC) AS pts_rank FROM (SELECT l_suppkey, year(o_orderdate) AS season, round(sum(l_extendedprice), 2) AS pts FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)")
def _(t):
    from tipoff.plans.models import Model, run_models

    models = [
        Model("leaders", ["season"], lambda f: W.leaderboard(f["season"], ["season"], ["pts"])),
        Model("season", ["game"], lambda f: f["game"].groupBy("l_suppkey", "season").agg(F.round(F.sum("l_extendedprice"), 2).alias("pts"))),
        Model("game", ["lineitem", "orders"], lambda f: f["lineitem"].join(f["orders"], c("l_orderkey") == c("o_orderkey")).withColumn("season", order_year())),
    ]
    return run_models(models, {"lineitem": t.lineitem, "orders": t.orders})[0]["leaders"]


@query("src_1_staged_scan", "SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'orders', count(*) FROM orders")
def _(t):
    from tipoff.operators.reshape import tagged_union
    from tipoff.sources.staging import load_staging

    found = load_staging(t.spark, t.sf_dir, ["nation", "orders", "not_there"])
    return tagged_union({k: d.agg(F.count(F.lit(1)).alias("n")) for k, d in found.items()}, "name").select("name", "n")


@query("src_7_lookup_join", "SELECT l_linenumber AS code, CASE l_linenumber WHEN 1 THEN 'field_goal_made' WHEN 2 THEN 'field_goal_missed' WHEN 3 THEN 'free_throw' WHEN 4 THEN 'rebound' WHEN 5 THEN 'turnover' WHEN 6 THEN 'foul' WHEN 7 THEN 'violation' ELSE 'unknown' END AS event_type, count(*) AS n FROM lineitem GROUP BY 1, 2")
def _(t):
    from tipoff.sources.staging import event_types

    d = F.broadcast(event_types(t.spark).withColumnRenamed("event_type_id", "code"))  # fourteen rows
    return t.lineitem.select(c("l_linenumber").alias("code")).join(d, "code", "left").groupBy("code", F.coalesce("event_type", F.lit("unknown")).alias("event_type")).agg(F.count(F.lit(1)).alias("n"))


@query("fn_6_json", "SELECT event_id, json_extract_string(json_object('u', user_id, 't', event_type), '$.t') AS t FROM events")
def _(t):
    j = F.to_json(F.struct(c("user_id").alias("u"), c("event_type").alias("t")))
    return t.events.select("event_id", F.get_json_object(j, "$.t").alias("t"))


@query("dq_2_24_schema", "SELECT 'customer' AS name, 1 AS version, 5 AS columns UNION ALL SELECT 'customer', 2, 6")
def _(t):
    now = t.customer.withColumn("c_phone", F.lit(None).cast("string"))
    added, _ = Q.schema_changes(dict(t.customer.dtypes), now)
    versions = [d for k, d in enumerate((t.customer, now)) if k == 0 or (added and Q.schema_hash(d) != Q.schema_hash(t.customer))]
    out = None
    for k, d in enumerate(versions, 1):  # one row for each version, from the table's own columns
        one = d.limit(1).select(F.lit("customer").alias("name"), F.lit(k).alias("version"), F.lit(len(d.columns)).alias("columns"))
        out = one if out is None else out.unionByName(one)
    return out


@query("pl_2_resume", "SELECT o_custkey, count(*) AS games FROM orders GROUP BY 1")
def _(t):
    from tipoff.plans.models import Model, run_models

    base = sinks.work_dir(t.spark)

    def keep(name, df):
        sinks.write_parquet(df, f"{base}/{name}")
        return t.spark.read.parquet(f"{base}/{name}")

    models = [Model("games", ["orders"], lambda f: f["orders"].select("o_custkey", "o_orderkey")), Model("totals", ["games"], lambda f: f["games"].groupBy("o_custkey").agg(F.count(F.lit(1)).alias("games")))]
    first, _ = run_models(models[:1], {"orders": t.orders}, keep)
    frames, report = run_models(models, {"orders": t.orders, "games": first["games"]}, keep, done={"games"})
    if report.status != {"games": "resumed", "totals": "ok"}:
        raise RuntimeError(str(report.status))
    return frames["totals"]


@query("str_2_live_union", "SELECT user_id, value, 'home' AS side FROM events WHERE event_type = 'view' UNION ALL SELECT user_id, value, 'away' FROM events WHERE event_type = 'click'")
def _(t):
    from tipoff.operators.reshape import tagged_union

    part = lambda kind: t.events.filter(c("event_type") == kind).select("user_id", "value")
    return tagged_union({"home": part("view"), "away": part("click")}, "side")
