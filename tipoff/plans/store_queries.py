"""Stored datasets: generations, atomic batches, multiset appends, files by size, snapshots and incremental rebuilds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tipoff.plans.catalogue import query
from tipoff.plans.refresh import KeyedModel, Warehouse
from tipoff.sources import sinks
from tipoff.sources.batches import BatchStore, Chunk
from tipoff.sources.generations import Generations
from tipoff.sources.multiset import MultisetTable
from tipoff.streaming import snapshots

c = F.col
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@query("snk_9_generations", """
WITH s AS (SELECT DISTINCT year(l_shipdate) AS y, l_returnflag AS kind, l_suppkey, l_partkey FROM lineitem),
p AS (SELECT y, kind FROM (SELECT DISTINCT y FROM s) CROSS JOIN (SELECT DISTINCT kind FROM s UNION ALL SELECT 'none'))
SELECT p.y, p.kind, count(s.l_suppkey) AS rows, CAST(2 AS BIGINT) AS generations, TRUE AS repeat_is_same FROM p LEFT JOIN s ON p.y = s.y AND p.kind = s.kind GROUP BY 1, 2""")
def _(t):
    """Supplier-part rows by pairs of year and kind: two upserts that overlap in a year, then a repeat, which names the generation that is there."""
    s = t.lineitem.select(F.year("l_shipdate").cast("long").alias("y"), c("l_returnflag").alias("kind"), "l_suppkey", "l_partkey").distinct()
    s = sinks.written(s)  # three upserts and the pairs read it
    kinds = s.select("kind").distinct().unionByName(t.spark.range(1).select(F.lit("none").alias("kind")))
    pairs = sinks.written(s.select("y").distinct().join(F.broadcast(kinds)))  # years by at most four kinds
    g = Generations(t.spark, sinks.work_dir(t.spark) + "/workload", ["y", "kind"])
    early, late = "y <= 1996", "y >= 1996"
    names = [g.upsert(s.filter(part), pairs.filter(part)) for part in (early, late, late)]
    return g.coverage().select("y", "kind", "rows", F.lit(len(set(names))).cast("long").alias("generations"), F.lit(names[1] == names[2]).alias("repeat_is_same"))


@query("snk_9_manifest_all", " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS rows, CAST((SELECT count(*) FROM (DESCRIBE {n})) AS INTEGER) AS columns FROM {n}" for n in TABLES))
def _(t):
    """Every table of the folder."""
    return sinks.manifest({n: getattr(t, n) for n in TABLES}).select("table", "rows", "columns")


@query("snk_7_atomic", """
SELECT 'first' AS step, 'lines' AS "table", count(*) AS rows, count(DISTINCT l_linenumber) AS chunks FROM lineitem UNION ALL SELECT 'first', 'orders', count(*), CAST(1 AS BIGINT) FROM orders
UNION ALL SELECT 'failed', 'lines', count(*), count(DISTINCT l_linenumber) FROM lineitem UNION ALL SELECT 'failed', 'orders', count(*), CAST(1 AS BIGINT) FROM orders
UNION ALL SELECT 'replaced', 'lines', count(*) - count(*) FILTER (WHERE l_linenumber = 1 AND l_quantity < 10), count(DISTINCT l_linenumber) FROM lineitem
UNION ALL SELECT 'replaced', 'orders', count(*), CAST(1 AS BIGINT) FROM orders UNION ALL SELECT 'replaced', 'customer', count(*), CAST(1 AS BIGINT) FROM customer""")
def _(t):
    """A batch of two tables; one that fails in its second chunk, of which nothing shows; and the same one allowed to replace."""
    store = BatchStore(t.spark, sinks.work_dir(t.spark) + "/staging")
    lines = [r[0] for r in t.lineitem.select("l_linenumber").distinct().orderBy("l_linenumber").collect()]  # a row for each line number

    def line(n, condition=None, replace=False):
        rows = t.lineitem.filter(c("l_linenumber") == n)
        return Chunk("lines", rows.filter(condition) if condition else rows, {"endpoint": "lines", "line": n}, n, replace)

    def seen(step):
        return store.journal().groupBy("table").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("chunks")).select(F.lit(step).alias("step"), "table", "rows", "chunks")

    store.persist([*(line(n) for n in lines), Chunk("orders", t.orders, {"endpoint": "orders"})])
    first = sinks.written(seen("first"))
    customer = Chunk("customer", t.customer, {"endpoint": "customer"})
    try:
        store.persist([customer, line(1, "l_quantity >= 10")])
    except ValueError:
        failed = sinks.written(seen("failed"))
    store.persist([customer, line(1, "l_quantity >= 10", True)])
    return first.unionByName(failed).unionByName(seen("replaced"))


@query("snk_8_materialized", "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS l_quantity, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_tax END AS l_tax FROM lineitem")
def _(t):
    """Chunks of three schemas: without a column, with text for numbers, and as wanted; in order of chunk and row."""
    store = BatchStore(t.spark, sinks.work_dir(t.spark) + "/staging")
    x = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")
    text = F.format_string("%.0f", "l_quantity")
    parts = [x.filter("l_linenumber = 1").drop("l_tax"), x.filter("l_linenumber = 2").withColumn("l_quantity", text), x.filter("l_linenumber > 2")]
    store.persist([Chunk("lines", p, {"part": k}, k) for k, p in enumerate(parts)])
    return store.materialize("lines", {"l_orderkey": "bigint", "l_linenumber": "int", "l_quantity": "bigint", "l_tax": "double"})


@query("snk_6_counted", """
WITH a AS (SELECT l_suppkey, l_linenumber, l_quantity FROM lineitem WHERE l_linenumber <= 3), b AS (SELECT l_suppkey, l_linenumber - 2 AS l_linenumber, l_quantity FROM lineitem WHERE l_linenumber BETWEEN 3 AND 5)
SELECT l_suppkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, l_quantity FROM a UNION ALL (SELECT l_suppkey, CAST(l_linenumber AS INTEGER), l_quantity FROM b EXCEPT ALL SELECT l_suppkey, CAST(l_linenumber AS INTEGER), l_quantity FROM a)""")
def _(t):
    """Two appends of rows that repeat, inside each and across them; then the second once more, which adds nothing."""
    x = t.lineitem.select("l_suppkey", "l_linenumber", "l_quantity")
    a, b = x.filter("l_linenumber <= 3"), x.filter("l_linenumber between 3 and 5").withColumn("l_linenumber", (c("l_linenumber") - 2).cast("int"))
    table = MultisetTable(t.spark, sinks.work_dir(t.spark) + "/rows", x.schema)
    for rows in (a, b, b):
        table.append(rows)
    table.compact()
    return table.read()


@query("snk_1_hot_value", "SELECT CASE WHEN l_linenumber <= 3 THEN 0 ELSE l_linenumber END AS part, count(*) AS n, round(sum(l_extendedprice), 2) AS total, TRUE AS replaced FROM lineitem GROUP BY 1")
def _(t):
    """A value with most of the rows is written by several tasks; the table is written twice, the second whole in place of the first."""
    path = sinks.work_dir(t.spark) + "/lineitem"
    rows = t.lineitem.withColumn("part", F.when(c("l_linenumber") <= 3, 0).otherwise(c("l_linenumber")))
    with snapshots.settings(t.spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}):
        sinks.write_parquet(rows.limit(1), path, "part")
        sinks.write_parquet(rows, path, "part")
    back = t.spark.read.parquet(path)
    left = sinks.Folder(t.spark, path.rsplit("/", 1)[0]).names()
    return back.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total")).withColumn("replaced", F.lit(left == ["lineitem"]))


@query("str_1_duplicates", "SELECT DISTINCT event_id, user_id, event_type FROM events")
def _(t):
    """Polls that overlap and repeat each other, over two runs of the stream: state keeps each row once, and no batch reads the table."""
    base = sinks.work_dir(t.spark)
    e = t.events.select("event_id", "user_id", "event_type")
    poll = lambda k, rows: rows.write.parquet(f"{base}/landing/poll-{k}")
    poll(0, e.filter("event_id % 3 = 0").unionByName(e.filter("event_id % 6 = 0")))
    poll(1, e.filter("event_id % 2 = 0"))
    snapshots.replay_snapshots(t.spark, f"{base}/landing", f"{base}/out", f"{base}/state", ["event_id"], "events", e.schema)
    poll(2, e)
    snapshots.replay_snapshots(t.spark, f"{base}/landing", f"{base}/out", f"{base}/state", ["event_id"], "events", e.schema)
    return t.spark.read.parquet(f"{base}/out").select("event_id", "user_id", "event_type")


def season_models() -> list[KeyedModel]:
    """Game totals from lines, a customer's seasons from games, seasons from those."""
    year = F.year("o_orderdate").cast("long")
    totals = KeyedModel("game_totals", ["lines"], ["l_orderkey"], lambda f: f["lines"].groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.round("l_extendedprice", 2).cast("decimal(20,2)")).cast("decimal(20,2)").alias("total")))

    def seasons(f):
        return f["games"].join(f["game_totals"], c("o_orderkey") == c("l_orderkey")).groupBy("o_custkey", year.alias("season")).agg(F.count(F.lit(1)).alias("games"), F.sum("total").cast("decimal(20,2)").alias("total"))

    def of_totals(rows, f):
        return f["games"].join(rows.select(c("l_orderkey").alias("o_orderkey")).distinct(), "o_orderkey", "left_semi").select("o_custkey", year.alias("season"))

    customers = KeyedModel(
        "customer_seasons", ["games", "game_totals"], ["o_custkey", "season"], seasons, {"games": [c("o_custkey"), year], "game_totals": of_totals},
        {"games": lambda df, k: df.withColumn("season", year).join(k, ["o_custkey", "season"], "left_semi"), "game_totals": None},
    )
    league = KeyedModel("seasons", ["customer_seasons"], ["season"], lambda f: f["customer_seasons"].groupBy("season").agg(F.sum("games").alias("games"), F.count(F.lit(1)).alias("customers"), F.sum("total").cast("decimal(20,2)").alias("total")))
    return [league, customers, totals]


def refreshed(t):
    """A warehouse loaded with all but the last 30 days' games, then updated with those and with one corrected customer's games."""
    w = Warehouse(t.spark, sinks.work_dir(t.spark) + "/warehouse", {"games": ["o_orderkey"], "lines": ["l_orderkey"]}, season_models())
    games = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    lines = sinks.written(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice").join(t.orders.select(c("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi"))
    last = games.agg(F.max("o_orderdate").alias("d"))
    new = games.join(F.broadcast(last)).filter(c("o_orderdate") > c("d") - F.expr("interval 30 days")).select("o_orderkey")
    new, old = sinks.written(new), sinks.written(games.join(new, "o_orderkey", "left_anti"))
    wrong = games.groupBy().agg(F.min("o_custkey").alias("k"))
    fix = sinks.written(old.join(F.broadcast(wrong), c("o_custkey") == c("k")).select("o_orderkey"))
    halved = lines.join(fix.select(c("o_orderkey").alias("l_orderkey")).withColumn("w", F.lit(2)), "l_orderkey", "left").withColumn("l_extendedprice", c("l_extendedprice") / F.coalesce("w", F.lit(1))).drop("w")
    stored = sinks.written(halved.join(new.select(c("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_anti"))
    w.update({"games": (old, old), "lines": (stored.select("l_orderkey").unionByName(old.select(c("o_orderkey").alias("l_orderkey"))), stored)})
    keys = new.unionByName(fix)
    report = w.update({"games": (new, games.join(new, "o_orderkey", "left_semi")), "lines": (keys.select(c("o_orderkey").alias("l_orderkey")), lines.join(keys.select(c("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi"))})
    return w, report


REBUILT = """
WITH g AS (SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS BIGINT) AS season, o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY AS late, o_custkey = (SELECT min(o_custkey) FROM orders) AS wrong FROM orders),
touched AS (SELECT * FROM g WHERE late OR wrong),
l AS (SELECT l_orderkey, CAST(round(l_extendedprice, 2) AS DECIMAL(20, 2)) AS p FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)),
gt AS (SELECT l_orderkey, sum(p) AS total FROM l GROUP BY 1),
cs AS (SELECT o_custkey, season, count(*) AS games, sum(total) AS total FROM g JOIN gt ON o_orderkey = l_orderkey GROUP BY 1, 2)
"""


@query("str_4_rebuild", REBUILT + "SELECT season, CAST(sum(games) AS BIGINT) AS games, count(*) AS customers, CAST(sum(total) AS DOUBLE) AS total FROM cs GROUP BY 1")
def _(t):
    """The last model after an update of touched keys, equal to a full rebuild."""
    w, _ = refreshed(t)
    return w.tables["seasons"].read().select("season", "games", "customers", c("total").cast("double").alias("total"))


@query("str_4_rebuilt_keys", REBUILT + """SELECT 'games' AS "table", count(*) AS keys FROM g WHERE late UNION ALL SELECT 'lines', count(*) FROM touched UNION ALL SELECT 'game_totals', count(*) FROM touched WHERE o_orderkey IN (SELECT l_orderkey FROM l)
UNION ALL SELECT 'customer_seasons', count(*) FROM (SELECT DISTINCT o_custkey, season FROM touched WHERE late OR o_orderkey IN (SELECT l_orderkey FROM l))
UNION ALL SELECT 'seasons', count(*) FROM (SELECT DISTINCT season FROM touched WHERE o_orderkey IN (SELECT l_orderkey FROM l))""")
def _(t):
    """How many keys of each table that update computed again."""
    _, report = refreshed(t)
    return t.spark.createDataFrame([(r["table"], r["keys"]) for r in report], '`table` string, keys long')
