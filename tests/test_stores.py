"""Stored datasets: logs, buckets, generations, batches, multisets, files by size, streaming state, rebuilds."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tipoff.plans import store_queries
from tipoff.plans.catalogue import Tables
from tipoff.plans.refresh import KeyedModel, Warehouse
from tipoff.sources import sinks
from tipoff.sources.batches import BatchStore, Chunk
from tipoff.sources.buckets import Buckets
from tipoff.sources.commits import CommitLog, Conflict
from tipoff.sources.generations import Generations
from tipoff.sources.multiset import MultisetTable
from tipoff.streaming import snapshots

KV = "k long, v string"


@pytest.fixture
def path(spark, tmp_path):
    return f"file://{tmp_path}"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_a_log_number_is_taken_once(spark, path):
    a, b = CommitLog(spark, path), CommitLog(spark, path)
    assert a.head() == -1 and a.entry(-1) is None
    a.commit(0, {"x": 1})
    with pytest.raises(Conflict):
        b.commit(0, {"x": 2})
    b.commit(1, {"x": 3})
    assert a.head() == 1 and a.entry(0) == {"x": 1} and not [n for n in a.folder.names() if not n.endswith(".json")]


def test_buckets_rewrite_only_what_they_must(spark, path):
    t = Buckets(spark, path, ["k"], 8)
    first = spark.createDataFrame([(i, f"v{i}") for i in range(100)], KV)
    assert t.read() is None and t.replace(first, first).changed
    before = t.state()["buckets"]
    key = spark.createDataFrame([(7,)], "k long")
    done = t.replace(key, spark.createDataFrame([(7, "new"), (7, "two")], KV))
    after = t.state()["buckets"]
    assert done.rewritten == 1 and sum(before[b] != after[b] for b in before) == 1
    assert rows(t.read()) == Counter([(i, f"v{i}") for i in range(100) if i != 7] + [(7, "new"), (7, "two")])
    assert rows(t.read(version=0)) == rows(first)
    again = t.replace(key, spark.createDataFrame([(7, "two"), (7, "new")], KV))
    assert not again.changed and t.log.head() == 1 and t.name() != t.name(0)
    assert t.replace(key, spark.createDataFrame([(7, "v7")], KV)).changed and t.name() == t.name(0)
    old = Buckets(spark, path, ["k"], 99)
    assert old.n == 8 and t.vacuum() > 0 and rows(t.read()) == rows(first)
    t.replace(first, first.filter("false"))
    assert t.read().count() == 0


def test_a_late_writer_of_buckets_is_refused(spark, path, monkeypatch):
    t = Buckets(spark, path, ["k"], 4)
    one = spark.createDataFrame([(1, "a")], KV)
    t.replace(one, one)
    late = Buckets(spark, path, ["k"])
    monkeypatch.setattr(late.log, "head", lambda n=late.log.head(): n)
    two = spark.createDataFrame([(2, "b")], KV)
    t.replace(two, two)
    folders = t.files.names()
    with pytest.raises(Conflict):
        late.replace(two, spark.createDataFrame([(2, "c")], KV))
    assert t.files.names() == folders and rows(t.read()) == Counter([(1, "a"), (2, "b")])


def test_generations(spark, path):
    schema = "season string, kind string, team long"
    g = Generations(spark, path, ["season", "kind"], 8)
    df = lambda *r: spark.createDataFrame(list(r), schema)
    one = g.upsert(df(("20", "r", 1), ("20", "r", 2), ("20", "r", 2)), df(("20", "r", None), ("20", "p", None)))
    assert rows(g.coverage()) == Counter([("20", "r", 2), ("20", "p", 0)]) and g.load().count() == 2
    two = g.upsert(df(("20", "p", 9)))
    assert two != one and rows(g.load()) == Counter([("20", "r", 1), ("20", "r", 2), ("20", "p", 9)])
    assert g.upsert(df(("20", "p", 9))) == two and g.table.log.head() == 1
    assert rows(g.load(version=0)) == Counter([("20", "r", 1), ("20", "r", 2)])
    assert rows(g.load(df(("20", "p", None)))) == Counter([("20", "p", 9)])
    m = g.manifest()
    assert m["generation"] == two and (m["rows"], m["pairs"], m["empty_pairs"]) == (3, 2, 0) and g.manifest(0)["empty_pairs"] == 1
    for bad in ((df(("21", "r", 1)), df(("20", "r", 1))), (df((None, "r", 1)), None)):
        with pytest.raises(ValueError, match="outside"):
            g.upsert(*bad)
    assert g.name() == two


def test_batches_are_atomic(spark, path):
    s = BatchStore(spark, path)
    df = lambda *r: spark.createDataFrame(list(r), KV)
    a, b = Chunk("x", df((1, "a"), (2, "b")), {"id": 1, "part": 2}, 2), Chunk("y", df((5, "e")), {"id": 1})
    assert s.persist([]).version == -1 and s.journal().count() == 0
    done = s.persist([a, b])
    assert (done.version, done.inserted, done.rows) == (0, 2, 3)
    assert Chunk("x", df(), {"part": 2, "id": 1}).id == a.id != Chunk("y", df(), {"part": 2, "id": 1}).id
    again = BatchStore(spark, path).persist([a, b])
    assert (again.replayed, again.inserted, again.version) == (2, 0, 0)
    files = s.files.names("x"), s.files.names("y")
    with pytest.raises(ValueError, match="other content"):
        s.persist([Chunk("x", df((3, "c")), {"id": 9}), Chunk("y", df((6, "f")), {"id": 1})])

    def fail():
        raise RuntimeError("stop")

    with pytest.raises(RuntimeError):
        s.persist([Chunk("x", df((3, "c")), {"id": 9})], before_commit=fail)
    with pytest.raises(ValueError, match="twice"):
        s.persist([a, a])
    assert (s.files.names("x"), s.files.names("y")) == files and rows(s.materialize("x")) == Counter([(1, "a"), (2, "b")])
    other = BatchStore(spark, path)
    done = s.persist([Chunk("x", df((3, "c")), {"id": 9}, 1)], before_commit=lambda: other.persist([Chunk("z", df((1, "z")), {"id": 1})]))
    assert done.version == 2 and other.materialize("z").count() == 1
    with pytest.raises(Conflict):
        s.persist([Chunk("x", df((4, "d")), {"id": 10})], before_commit=lambda: other.persist([Chunk("x", df((4, "other")), {"id": 10})]))
    assert [tuple(r) for r in s.materialize("x").collect()] == [(4, "other"), (3, "c"), (1, "a"), (2, "b")]
    assert s.persist([Chunk("x", df((8, "h")), {"id": 9}, 1, True)]).replaced == 1
    assert [r.k for r in s.materialize("x").collect()] == [4, 8, 1, 2]
    wide = s.materialize("x", {"v": "string", "k": "string", "more": "double"})
    assert wide.dtypes == [("v", "string"), ("k", "string"), ("more", "double")] and tuple(wide.first()) == ("other", "4", None)


def test_multiset_appends_shuffle_new_rows_only(spark, path):
    schema = spark.createDataFrame([], KV).schema
    t = MultisetTable(spark, path, schema, 4)
    a = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], KV)
    b = spark.createDataFrame([(1, "a")] * 3 + [(2, None), (4, "d")], KV)
    t.append(a)
    t.append(b)
    want = rows(a) + rows(b.exceptAll(a))
    assert rows(t.read()) == want == rows(MultisetTable(spark, path, schema).read())
    with snapshots.settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        plan = t.missing(b)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("SortMergeJoin") :]
    assert "Bucketed: true" in scan and "Exchange" not in scan[scan.rindex("+- *(", 0, scan.index("FileScan")) : scan.index("FileScan")]
    assert plan.count("Exchange hashpartitioning") == 2  # both of the new rows
    t.append(a)
    t.compact()
    t.append(b)
    assert rows(t.read()) == want
    other = MultisetTable(spark, path, schema)
    other.log.head = lambda n=other.log.head(): n
    t.append(spark.createDataFrame([(9, "z")], KV))
    with pytest.raises(Conflict):
        other.append(spark.createDataFrame([(9, "z")], KV))
    assert rows(t.read())[(9, "z")] == 1


def test_a_hot_value_is_written_in_several_files(spark, path):
    df = spark.range(200_000).select(F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 3)).alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    with snapshots.settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}):
        sinks.write_parquet(df, f"{path}/t", "p")
    files = [f for f in os.listdir(f"{path[7:]}/t/p=hot") if f.endswith(".parquet")]
    assert len(files) > 3 and rows(spark.read.parquet(f"{path}/t").select("p", "x")) == rows(df)
    sinks.write_parquet(df.limit(5), f"{path}/t")
    assert spark.read.parquet(f"{path}/t").count() == 5 and os.listdir(path[7:]) == ["t"]


def test_streaming_state_drops_duplicates(spark, path):
    e = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (2, "a")], KV)
    e.coalesce(1).write.parquet(f"{path}/in/0")
    args = (spark, f"{path}/in", f"{path}/out", f"{path}/state", ["k"], "live", e.schema)
    snapshots.replay_snapshots(*args)
    e.unionByName(spark.createDataFrame([(3, "z")], KV)).coalesce(1).write.parquet(f"{path}/in/1")
    progress = snapshots.replay_snapshots(*args)
    assert rows(spark.read.parquet(f"{path}/out").select("k", "v")) == Counter([(1, "a"), (1, "b"), (2, "a"), (3, "z")])
    state = progress[-1]["stateOperators"][0]
    assert state["numRowsTotal"] == 4 and "rocksdbPutCount" in state["customMetrics"]


def test_streaming_state_within_a_watermark(spark, path):
    e = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:00:00"), (2, "2024-01-01 00:00:05")], "k long, at string").withColumn("at", F.to_timestamp("at"))
    e.coalesce(1).write.parquet(f"{path}/in/0")
    snapshots.replay_snapshots(spark, f"{path}/in", f"{path}/out", f"{path}/state", ["k"], "live", e.schema, "at", "1 hour")
    assert spark.read.parquet(f"{path}/out").count() == 2


def test_rebuilds_stop_where_nothing_changes(spark, path):
    total = KeyedModel("total", ["src"], ["k"], lambda f: f["src"].groupBy("k").agg(F.sum("n").alias("n")))
    parity = KeyedModel("parity", ["total"], ["odd"], lambda f: f["total"].groupBy((F.col("n") % 2).alias("odd")).agg(F.count(F.lit(1)).alias("c")), {"total": [F.col("n") % 2]}, {"total": lambda df, k: df.withColumn("odd", F.col("n") % 2).join(k, "odd", "left_semi")})
    w = Warehouse(spark, path, {"src": ["k"]}, [parity, total], 4)
    df = lambda *r: spark.createDataFrame(list(r), "k long, n long")
    w.update({"src": (df((1, 0), (2, 0)), df((1, 1), (1, 2), (2, 2)))})
    assert rows(w.tables["parity"].read()) == Counter([(1, 1), (0, 1)])
    report = w.update({"src": (df((1, 0)), df((1, 2), (1, 1)))})
    assert [(r["table"], r["changed"]) for r in report] == [("src", 0)]
    report = w.update({"src": (df((1, 0)), df((1, 3)))})
    assert {r["table"]: r["changed"] for r in report} == {"src": 3, "total": 0}
    report = w.update({"src": (df((1, 0), (3, 0)), df((1, 4), (3, 4)))})
    assert {r["table"]: r["keys"] for r in report} == {"src": 2, "total": 2, "parity": 2}
    assert rows(w.tables["parity"].read()) == Counter([(0, 3)])


def test_an_update_equals_a_full_load(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    w, _ = store_queries.refreshed(t)
    full = Warehouse(spark, sinks.work_dir(spark), {"games": ["o_orderkey"], "lines": ["l_orderkey"]}, store_queries.season_models())
    f = w.frames()
    full.update({n: (f[n], f[n]) for n in ("games", "lines")})
    for m in ("game_totals", "customer_seasons", "seasons"):
        cols = f[m].columns
        assert rows(f[m]) == rows(full.tables[m].read().select(*cols))


def test_a_stream_takes_many_small_files_in_one_batch(spark, path):
    """The number of batches, each with its own state commit, grows with the landed bytes, not with the files."""
    spark.range(90).selectExpr("id % 60 as k", "'v' as v").repartition(9).write.parquet(f"{path}/landing/poll")
    run = lambda: snapshots.replay_snapshots(spark, f"{path}/landing", f"{path}/out", f"{path}/state", ["k"], "s", spark.createDataFrame([], KV).schema)
    assert len([p for p in run() if p["numInputRows"]]) == 1
    spark.range(70).selectExpr("id as k", "'v' as v").repartition(5).write.parquet(f"{path}/landing/poll-2")
    assert len([p for p in run() if p["numInputRows"]]) == 1
    assert rows(spark.read.parquet(f"{path}/out").select("k", "v")) == Counter((k, "v") for k in range(70))


def test_an_upsert_makes_its_rows_once(spark, path):
    seen = spark.sparkContext.accumulator(0)

    def counted(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    made = spark.createDataFrame([(i % 3, "a", i) for i in range(30)], "y long, kind string, v long").mapInPandas(counted, "y long, kind string, v long")
    g = Generations(spark, path, ["y", "kind"], 4)
    g.upsert(made)
    assert seen.value == 30 and g.load().count() == 30
