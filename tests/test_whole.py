"""Queries that must cover all of their input."""

from pyspark.sql import functions as F

from tipoff.operators import analysis as N
from tipoff.plans import catalogue

SF = "/root/testdata/sf0.001"
QUERIES = catalogue.queries()


def test_walk_forward_predicts_every_season_from_the_fourth(spark):
    per = {r[0]: r[1] for r in spark.read.parquet(f"{SF}/orders.parquet").groupBy(F.year("o_orderdate")).count().collect()}
    got = {r.season: r.n for r in QUERIES["an_15_walk_forward"](spark, SF).collect()}
    assert len(per) > 5 and got == {s: per[s] for s in sorted(per)[3:]}


def test_walk_forward_learns_what_no_line_separates(spark):
    """Two trees' models see that the label is where two signs differ; one logistic model of the two columns can't."""
    rows = [(s, float(x), float(y) if (x + y + s) % 7 else None, int((x > 0) != (y > 0))) for s in range(5) for x in range(-6, 7) for y in range(-6, 7) if x and y]
    out = N.walk_forward(spark.createDataFrame(rows, "season int, x double, y double, label int"), "season", ["x", "y"], "label").collect()
    assert {r.season for r in out} == {3, 4}
    assert sum((r.probability > 0.5) == (r.label == 1) for r in out) > 0.75 * len(out)


def test_walk_forward_trains_on_every_row_as_weights(spark, tmp_path, monkeypatch):
    """Rows that trees can't tell apart are one row of their weight: ten times the rows make no more rows to train on."""
    monkeypatch.setattr(N.sinks, "work_dir", lambda _: str(tmp_path))
    rows = [(s, float(x), None if x == 3 else float(x % 4), int(x > 5)) for s in range(3) for x in range(10)] * 10
    N.walk_forward(spark.createDataFrame(rows, "season int, x double, y double, label int"), "season", ["x", "y"], "label", seasons=[1])
    train = spark.read.parquet(f"{tmp_path}/train-0")
    assert train.count() == 10 and train.agg(F.sum("_n")).collect()[0][0] == 100


def test_logs_and_chunks_hold_every_row(spark):
    orders, lines = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("orders", "lineitem"))
    log = QUERIES["q_player_game_log_all"](spark, SF)
    days = [r.game_date for r in log.select("game_date").collect()]
    assert days == sorted(days, reverse=True) and len(days) == lines.count()
    assert log.select("player_id").distinct().count() == lines.select("l_suppkey").distinct().count() > 1
    assert QUERIES["q_team_game_log_all"](spark, SF).count() == orders.count()
    kept = QUERIES["snk_7_8_chunks_all"](spark, SF)
    assert kept.count() == lines.count() and kept.select("l_linenumber").distinct().count() > 3
