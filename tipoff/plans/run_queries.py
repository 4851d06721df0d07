"""Runs, loads, sinks and the quality operators that need more than one table or pass; similarity and mixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from tipoff.operators import analysis as N
from tipoff.operators import quality as Q
from tipoff.operators import windows as W
from tipoff.plans.analysis_queries import count_all, order_year
from tipoff.plans.catalogue import query, rounded
from tipoff.plans.core_queries import SCD, customer_status, lines
from tipoff.sources import sinks

c = F.col


@query("snk_4_fan_out", "SELECT 'parquet' AS sink, TRUE AS ok, count(*) AS rows FROM embeddings UNION ALL SELECT 'csv', FALSE, NULL UNION ALL SELECT 'json', TRUE, count(*) FROM embeddings")
def _(t):
    """An array column fits Parquet and JSON, but not CSV: the secondary's failure is reported, the others go on."""
    base = sinks.work_dir(t.spark)
    report = sinks.fan_out(t.embeddings, {"parquet": lambda d: sinks.write_parquet(d, f"{base}/p"), "csv": lambda d: sinks.write_csv(d, f"{base}/c"), "json": lambda d: d.write.json(f"{base}/j")})
    read = {"parquet": lambda: t.spark.read.parquet(f"{base}/p"), "json": lambda: t.spark.read.schema(t.embeddings.schema).json(f"{base}/j")}
    out = None
    for name, ok, _ in report:
        rows = read[name]().agg(count_all().alias("rows")) if ok else t.embeddings.agg(F.lit(None).cast("long").alias("rows"))
        one = rows.select(F.lit(name).alias("sink"), F.lit(ok).alias("ok"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


@query("snk_7_journal", "SELECT l_linenumber, count(*) AS rows, CAST(1 AS BIGINT) AS chunks FROM lineitem GROUP BY 1")
def _(t):
    """A second store on the same path, as another process would open it, knows the chunks: their replays add nothing."""
    path = sinks.work_dir(t.spark) + "/chunks"
    known = [r[0] for r in t.lineitem.select("l_linenumber").distinct().orderBy("l_linenumber").collect()]  # a row for each line number
    for k in known:
        part = t.lineitem.filter(c("l_linenumber").eqNullSafe(F.lit(k))).select("l_orderkey", "l_linenumber")
        if not sinks.ChunkStore(t.spark, path).append(f"line-{k}", part) or sinks.ChunkStore(t.spark, path).append(f"line-{k}", part):
            raise RuntimeError(f"line-{k} was not appended once")
    store = sinks.ChunkStore(t.spark, path)
    held = store.journal().select(F.regexp_extract("chunk_id", r"line-(\d+)", 1).cast("int").alias("l_linenumber"), c("rows").alias("entered"))
    got = store.materialize().groupBy("l_linenumber").agg(count_all().alias("rows"))
    return got.join(held, "l_linenumber").filter("rows = entered").groupBy("l_linenumber").agg(F.sum("rows").alias("rows"), count_all().alias("chunks"))


def stored_models(fail: bool):
    from tipoff.plans.models import Model

    def totals(f):
        if fail:
            raise RuntimeError("no memory")
        return f["games"].groupBy("o_custkey").agg(count_all().alias("games"))

    return [
        Model("games", ["orders"], lambda f: f["orders"].select("o_custkey", "o_orderkey")), Model("totals", ["games"], totals),
        Model("leaders", ["totals"], lambda f: f["totals"].filter("games >= 10")),
    ]


@query("pl_2_stored_resume", """SELECT 0 AS attempt, 'games' AS model, 'ok' AS status, count(*) AS rows FROM orders UNION ALL SELECT 0, 'totals', 'failed', NULL UNION ALL SELECT 0, 'leaders', 'skipped', NULL
UNION ALL SELECT 1, 'totals', 'ok', count(DISTINCT o_custkey) FROM orders UNION ALL SELECT 1, 'leaders', 'ok', count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 10)""")
def _(t):
    """The first attempt fails at the second model; the second one reads what the run has finished and runs the rest."""
    from tipoff.plans.models import RunStore

    path = sinks.work_dir(t.spark)
    for fail in (True, False):
        _, report = RunStore(t.spark, path, "nightly").run(stored_models(fail), {"orders": t.orders})
    if report.status["games"] != "resumed":
        raise RuntimeError(str(report.status))
    return RunStore(t.spark, path, "nightly").log().select(c("seq").cast("int").alias("attempt"), "model", "status", "rows")


@query("pl_3_run_metrics", """SELECT 'games' AS model, count(*) AS rows, 2 AS columns, 'ok' AS status FROM orders UNION ALL SELECT 'totals', count(DISTINCT o_custkey), 2, 'ok' FROM orders
UNION ALL SELECT 'leaders', count(*), 2, 'ok' FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 10)""")
def _(t):
    """Rows, columns and status of each model from the stored log; the slowest five of a run of three are all of it."""
    from tipoff.plans.models import RunStore, run_summary, slowest

    store = RunStore(t.spark, sinks.work_dir(t.spark), "metrics")
    store.run(stored_models(False), {"orders": t.orders})
    log = store.log()
    ok = run_summary(log).filter("ok = 3 and failed = 0 and skipped = 0 and seconds > 0").select("run_id")
    return log.join(slowest(log).select("run_id", "model"), ["run_id", "model"]).join(ok, "run_id").select("model", "rows", "columns", "status")


@query("pl_4_load", """SELECT 'orders' AS "table", 'ok' AS status, count(*) AS rows, 6 AS columns, CAST(max(o_orderkey) AS VARCHAR) AS mark, CASE WHEN count(*) FILTER (WHERE o_totalprice > 400000) > 0 THEN 50.0 ELSE 100.0 END AS score, 'parquet,csv' AS sinks FROM orders
UNION ALL SELECT 'embeddings', 'partial', count(*), 3, CAST(max(vec_id) AS VARCHAR), 100.0, 'parquet' FROM embeddings UNION ALL SELECT 'broken', 'failed', NULL, NULL, NULL, NULL, NULL""")
def _(t):
    from tipoff.plans.load import Load, load_tables

    base = sinks.work_dir(t.spark)
    csv = lambda name: {"csv": lambda d: sinks.write_csv(d, f"{base}/csv/{name}")}
    loads = {
        "orders": Load(t.orders, "o_orderkey", {"keyed": c("o_orderkey").isNotNull(), "modest": c("o_totalprice") <= 400000}, csv("orders")),
        "embeddings": Load(t.embeddings, "vec_id", {"keyed": c("vec_id").isNotNull()}, csv("embeddings")),
        "broken": Load(t.customer.select(F.raise_error(F.lit("bad row")).cast("int").alias("x"))),
    }
    load_tables(t.spark, loads, f"{base}/load")
    return t.spark.read.parquet(f"{base}/load/_metadata").select("table", "status", "rows", "columns", "mark", "score", "sinks")


@query("dq_9_scores", """WITH r(t, layer, ok) AS (SELECT 'orders', 'keys', count(*) = count(DISTINCT o_orderkey) FROM orders UNION ALL SELECT 'orders', 'nulls', count(*) FILTER (WHERE o_custkey IS NULL) = 0 FROM orders UNION ALL SELECT 'orders', 'range', count(*) FILTER (WHERE NOT o_totalprice <= 100000) = 0 FROM orders
UNION ALL SELECT 'lineitem', 'keys', count(*) = (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) FROM lineitem UNION ALL SELECT 'lineitem', 'references', count(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) = 0 FROM lineitem UNION ALL SELECT 'lineitem', 'range', count(*) FILTER (WHERE NOT l_quantity BETWEEN 1 AND 50) = 0 FROM lineitem
UNION ALL SELECT 'labels', 'references', count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM documents)) = 0 FROM labels UNION ALL SELECT 'customer', 'range', count(*) FILTER (WHERE NOT c_acctbal >= 0) = 0 FROM customer)
SELECT t AS "table", count(*) AS checks, count(*) FILTER (WHERE NOT ok) AS failed, round(count(*) FILTER (WHERE ok) * 100 / count(*), 6) AS score FROM r GROUP BY 1""")
def _(t):
    from tipoff.operators.joins import orphans

    def row(table, layer, check, frame, ok):
        return frame.agg(ok.alias("passed")).select(F.lit(table).alias("table"), F.lit(layer).alias("layer"), F.lit(check).alias("check"), "passed")

    none = count_all() == 0
    parts = [
        row("orders", "keys", "unique", t.orders, count_all() == F.count_distinct("o_orderkey")), row("orders", "nulls", "customer", t.orders, F.count_if(c("o_custkey").isNull()) == 0),
        row("orders", "range", "total", t.orders, F.count_if(~(c("o_totalprice") <= 100000)) == 0),
        row("lineitem", "keys", "unique", t.lineitem, count_all() == F.count_distinct(F.struct("l_orderkey", "l_linenumber"))), row("lineitem", "references", "order", orphans(t.lineitem, "l_orderkey", t.orders, "o_orderkey"), none),
        row("lineitem", "range", "quantity", t.lineitem, F.count_if(~c("l_quantity").between(1, 50)) == 0),
        row("labels", "references", "document", orphans(t.labels, "doc_id", t.documents, "doc_id"), none), row("customer", "range", "balance", t.customer, F.count_if(~(c("c_acctbal") >= 0)) == 0),
    ]
    results = parts[0]
    for p in parts[1:]:
        results = results.unionByName(p)
    return rounded(Q.quality_scores(results).select("table", "checks", "failed", "score"), 6)


@query("dq_11_anchors", """SELECT 'games' AS domain, CAST(2 AS BIGINT) AS anchors, CAST(2 AS BIGINT) AS present, CASE WHEN (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem) > 0 THEN 'ok' ELSE 'empty' END AS status
UNION ALL SELECT 'text', 3, 2, CASE WHEN (SELECT count(*) FROM documents) + (SELECT count(*) FROM pages) > 0 THEN 'ok' ELSE 'empty' END UNION ALL SELECT 'draft', 2, 0, 'missing' UNION ALL SELECT 'refused', 1, 1, CASE WHEN (SELECT count(*) FROM events WHERE event_type = 'refund') > 0 THEN 'ok' ELSE 'empty' END""")
def _(t):
    from tipoff.operators.reshape import tagged_union
    from tipoff.sources.staging import load_staging

    domains = {"games": ["orders", "lineitem"], "text": ["documents", "pages", "articles"], "draft": ["draft", "combine"], "refused": ["refunds"]}
    found = load_staging(t.spark, t.sf_dir, [n for d in domains.values() for n in d]) | {"refunds": t.events.filter("event_type = 'refund'")}
    counts = tagged_union({n: d.agg(count_all().alias("n")) for n, d in found.items()}, "name")
    wanted = t.spark.createDataFrame([(d, n) for d, names in domains.items() for n in names], "domain string, name string")
    return Q.anchors(counts, wanted)


@query("dq_13_row_parity", """SELECT 'enriched' AS output, (SELECT count(*) FROM lineitem) AS source_rows, count(*) AS output_rows, count(*) = (SELECT count(*) FROM lineitem) AS ok FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
UNION ALL SELECT 'finished', (SELECT count(*) FROM lineitem), count(*), count(*) = (SELECT count(*) FROM lineitem) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'
UNION ALL SELECT 'distinct_lines', (SELECT count(*) FROM lineitem), count(*), count(*) = (SELECT count(*) FROM lineitem) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""")
def _(t):
    from tipoff.operators.joins import enrich

    return Q.parity(t.lineitem, {
        "enriched": enrich(t.lineitem.withColumnRenamed("l_partkey", "p_partkey"), (t.part, ["p_partkey"])), "finished": lines(t).filter("o_orderstatus = 'F'"), "distinct_lines": t.lineitem.select("l_orderkey", "l_linenumber").distinct(),
    })


VERSIONS = """o AS (SELECT o_custkey AS k, year(o_orderdate) AS season, list_sort(list(DISTINCT o_orderpriority || ':' || o_orderstatus)) AS cols FROM orders GROUP BY 1, 2),
v AS (SELECT *, lag(cols) OVER w AS was, first(cols) OVER w AS base, sha256(array_to_string(cols, '|')) AS hash FROM o WINDOW w AS (PARTITION BY k ORDER BY season))"""


def observed_schemas(t):
    """Customers stand for tables, seasons for observations, priorities for columns and statuses for their types."""
    return t.orders.select(c("o_custkey").alias("k"), order_year().alias("season"), c("o_orderpriority").alias("column"), c("o_orderstatus").alias("type"))


@query("dq_24_versions", f"""WITH {VERSIONS} SELECT k, season, hash, count(*) FILTER (WHERE was IS NULL OR was <> cols) OVER (PARTITION BY k ORDER BY season) AS version, CASE WHEN was IS NOT NULL THEN len(list_filter(cols, lambda x: NOT list_contains(was, x))) END AS n_added, len(list_filter(was, lambda x: NOT list_contains(cols, x))) AS n_removed,
coalesce(len(list_filter(was, lambda x: NOT list_contains(cols, x))) > 0, FALSE) AND season < 2000 AS refused FROM v""")
def _(t):
    v = Q.schema_versions(observed_schemas(t), ["k"], "season", allowed=c("season") >= 2000)
    return v.select("k", "season", "hash", "version", F.size("added").cast("long").alias("n_added"), F.size("removed").cast("long").alias("n_removed"), "refused").withColumns({x: F.when(c(x) >= 0, c(x)) for x in ("n_added", "n_removed")})


@query("dq_2_drift", f"WITH {VERSIONS} SELECT k, count(*) AS observed, count(*) FILTER (WHERE cols <> base) AS drifted FROM v GROUP BY 1")
def _(t):
    v = Q.schema_versions(observed_schemas(t), ["k"], "season")
    return v.groupBy("k").agg(count_all().alias("observed"), F.count_if("drifted").alias("drifted"))


@query("str_5_states", """WITH m AS (SELECT max(ts) AS now FROM events), s AS (SELECT user_id, event_id, ts, CASE WHEN event_type IN ('view', 'click') THEN 'start' WHEN event_type = 'error' THEN 'failure' WHEN event_type = 'purchase' THEN 'success' END AS k FROM events),
g AS (SELECT user_id, count(*) FILTER (WHERE k = 'failure') AS n, max_by(k, event_id) AS last, max_by(ts, event_id) AS seen FROM s WHERE k IS NOT NULL GROUP BY 1)
SELECT user_id, CASE last WHEN 'success' THEN 'done' WHEN 'start' THEN CASE WHEN seen < now - INTERVAL 3 DAY THEN 'pending' ELSE 'running' END ELSE CASE WHEN n >= 5 THEN 'abandoned' ELSE 'failed' END END AS status, least(n, 5) AS retries FROM g, m""")
def _(t):
    from tipoff.streaming.snapshots import attempt_states

    now = t.events.agg(F.max("ts").alias("now"))  # one row
    kind = F.when(c("event_type").isin("view", "click"), "start").when(c("event_type") == "error", "failure").when(c("event_type") == "purchase", "success")
    log = t.events.join(F.broadcast(now))
    return attempt_states(log, ["user_id"], "event_id", "ts", kind, 5, c("now"), "3 days")


@query("flt_6_current", f"WITH {SCD} SELECT o_orderstatus, count(*) AS customers FROM scd WHERE valid_to IS NULL GROUP BY 1")
def _(t):
    return customer_status(t).filter("is_current").groupBy("o_orderstatus").agg(count_all().alias("customers"))


PLAYER = "SELECT s_suppkey AS id, s_nationkey AS pos, avg(l_quantity) AS a, avg(l_extendedprice) AS b, avg(l_discount) AS d FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2"
SCORED = f"""p AS ({PLAYER}), m AS (SELECT avg(a) AS ma, stddev_samp(a) AS sa, avg(b) AS mb, stddev_samp(b) AS sb, avg(d) AS md, stddev_samp(d) AS sd FROM p), z AS (SELECT id, pos, (a - ma) / sa AS a, (b - mb) / sb AS b, (d - md) / sd AS d FROM p, m),
t AS (SELECT pos AS tpos, a AS ta, b AS tb, d AS td FROM z WHERE id = 1)"""


def players(t):
    j = t.lineitem.join(t.supplier, c("l_suppkey") == c("s_suppkey"))
    return j.groupBy(c("s_suppkey").alias("id"), c("s_nationkey").alias("pos")).agg(F.avg("l_quantity").alias("a"), F.avg("l_extendedprice").alias("b"), F.avg("l_discount").alias("d"))


@query("an_7_distance", f"WITH {SCORED} SELECT id, round(1 / (1 + sqrt((a - ta) ** 2 + (b - tb) ** 2 + (d - td) ** 2)), 5) AS similarity FROM z, t WHERE id <> 1 ORDER BY 1 / (1 + sqrt((a - ta) ** 2 + (b - tb) ** 2 + (d - td) ** 2)) DESC, id LIMIT 10")
def _(t):
    return rounded(N.similar_by_distance(players(t), "id", ["a", "b", "d"], 1), 5)


@query("an_7_position", f"WITH {SCORED} SELECT id, round(1 / (1 + abs(a - ta) + abs(b - tb) + abs(d - td) + CASE WHEN pos = tpos THEN 0 ELSE 1 END), 5) AS similarity FROM z, t WHERE id <> 1 ORDER BY 1 / (1 + abs(a - ta) + abs(b - tb) + abs(d - td) + CASE WHEN pos = tpos THEN 0 ELSE 1 END) DESC, id LIMIT 10")
def _(t):
    return rounded(N.similar_by_distance(players(t), "id", ["a", "b", "d"], 1, position="pos"), 5)


@query("an_8_era_edges", """WITH p AS (SELECT year(o_orderdate) AS y, l_suppkey AS s, avg(l_quantity) AS a, avg(l_extendedprice) AS b, avg(l_tax) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
z AS (SELECT y * 1000000 + s AS id, [(a - avg(a) OVER w) / stddev_samp(a) OVER w, (b - avg(b) OVER w) / stddev_samp(b) OVER w, (d - avg(d) OVER w) / stddev_samp(d) OVER w] AS v FROM p WINDOW w AS (PARTITION BY y))
SELECT src, dst FROM (SELECT x.id AS src, q.id AS dst, row_number() OVER (PARTITION BY x.id ORDER BY list_cosine_similarity(x.v, q.v) DESC, q.id) AS r FROM z x JOIN z q ON x.id <> q.id) WHERE r <= 3""")
def _(t):
    s = lines(t).groupBy(order_year().alias("y"), c("l_suppkey").alias("s")).agg(F.avg("l_quantity").alias("a"), F.avg("l_extendedprice").alias("b"), F.avg("l_tax").alias("d"))
    z = W.z_scores(s, ["y"], ["a", "b", "d"]).select((c("y").cast("long") * 1000000 + c("s")).alias("id"), F.array("a_z", "b_z", "d_z").alias("v"), F.lit(0).alias("all"))
    return N.pruned_edges(sinks.written(z), "id", "v", "all")[0].select("src", "dst")


@query("an_10_mixtures")
def _(t):
    s = t.orders.groupBy("o_custkey").agg(count_all().alias("n"), F.avg("o_totalprice").alias("m"), F.max("o_totalprice").alias("top"))
    return N.mixtures(s.select("o_custkey", F.array("n", "m", "top").cast("array<double>").alias("v")), "v", [2, 3, 4])[0].groupBy("cluster").agg(count_all().alias("n"))
