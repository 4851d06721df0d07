"""Data quality, coverage and profiling. Each check is an aggregation over one scan."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tipoff.operators.reshape import typed
from tipoff.operators.windows import dense_key


def conform(df: DataFrame, schema: dict[str, str], optional: set[str] = frozenset()) -> DataFrame:
    """The columns of a contract, cast; extra columns go, optional ones may be missing, others must be there."""
    missing = [c for c in schema if c not in df.columns and c not in optional]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*(typed(df, c, t) for c, t in schema.items()))


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Counts of rows that break each rule (a rule is true for good rows; null counts as broken)."""
    return df.agg(*(F.count_if(~F.coalesce(ok, F.lit(False))).alias(n) for n, ok in rules.items()))


def count_anomalies(counts: DataFrame, name: str, value: str, limit: float = 3.0) -> DataFrame:
    """Counts whose z-score exceeds the limit; with no spread, those that differ from the mean."""
    s = counts.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    z = F.try_divide(F.col(value) - F.col("mean"), F.col("sd"))
    bad = F.when(F.coalesce("sd", F.lit(0.0)) == 0, F.col(value) != F.col("mean")).otherwise(F.abs(z) > limit)
    return counts.join(F.broadcast(s)).select(name, value, z.alias("z"), bad.alias("anomaly"))


def null_rates(df: DataFrame, cols: list[str]) -> DataFrame:
    one = df.agg(F.count(F.lit(1)).alias("_n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in cols))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.try_divide(F.col(c).cast("double"), F.col("_n")).alias("null_rate")) for c in cols))
    return one.select(F.explode(rows).alias("x")).select("x.*")


def schema_hash(df: DataFrame) -> str:
    return hashlib.sha256("|".join(sorted(f"{c}:{t}" for c, t in df.dtypes)).encode()).hexdigest()


def schema_changes(old: dict[str, str], new: DataFrame, allow_removed: bool = False) -> tuple[list[str], list[str]]:
    """Added and removed columns; removals are refused unless allowed."""
    now = dict(new.dtypes)
    added, removed = sorted(set(now) - set(old)), sorted(set(old) - set(now))
    if removed and not allow_removed:
        raise ValueError(f"columns removed: {removed}")
    return added, removed


def coverage(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    """Share of expected keys that are there, with an error flag beyond a tenth missing."""
    got = expected.select(*keys).distinct().join(actual.select(*keys).distinct().withColumn("_there", F.lit(1)), keys, "left")
    miss = F.count_if(F.col("_there").isNull())
    return got.agg(F.count(F.lit(1)).alias("expected"), miss.alias("missing"), (miss > 0.1 * F.count(F.lit(1))).alias("error"))


def low_counts(counts: DataFrame, value: str, share: float = 0.3, least: int = 3) -> DataFrame:
    """Rows below a share of the upper median, if there are enough rows: counts are one row a season."""
    med = counts.agg(F.sort_array(F.collect_list(value)).alias("v")).select(F.when(F.size("v") >= least, F.get("v", F.floor(F.size("v") / 2).cast("int"))).alias("median"))
    return counts.join(F.broadcast(med)).filter(F.col(value) < share * F.col("median")).drop("median")


def profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows, null share, distinct values, min, max, p50, p95 of numeric columns, in one pass."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"), F.avg(F.col(c).isNull().cast("double")).alias("null_share"), F.count_distinct(c).alias("distinct"),
                          F.min(x).alias("min"), F.max(x).alias("max"), F.percentile(x, F.lit(0.5)).alias("p50"), F.percentile(x, F.lit(0.95)).alias("p95")).alias(c)]
    return df.agg(*aggs).select(F.explode(F.array(*cols)).alias("x")).select("x.*")


def gaps(expected: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Expected work that is not done."""
    return expected.select(*keys).distinct().join(done.select(*keys).distinct(), keys, "left_anti")


def status_matrix(expected: DataFrame, actual: DataFrame, journal: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Each scope's status from what was expected, found and journalled; the first rule that holds names it.

    expected: keys; actual: keys, rows; journal: keys, status (done, failed, abandoned, running, skipped), and the column that orders a scope's
    entries if it may have several: the last one counts.
    """
    x = expected.select(*keys, F.lit(True).alias("e")).distinct()
    a = actual.groupBy(*keys).agg(F.sum("rows").alias("rows"))
    j = journal.groupBy(*keys).agg((F.max_by("status", order) if order else F.max("status")).alias("status"))
    all_ = x.join(a, keys, "full").join(j, keys, "full")
    e, r, s = F.coalesce("e", F.lit(False)), F.coalesce("rows", F.lit(0)), F.col("status")
    rule = (
        F.when(e & (r > 0) & (s == "done"), "complete").when(e & (r > 0) & s.isNull(), "present_unjournaled").when(e & (r > 0) & (s == "running"), "in_progress")
        .when(e & (r > 0), "present_after_failure").when(e & (s == "done"), "empty_done").when(e & (s == "abandoned"), "abandoned").when(e & (s == "failed"), "failed")
        .when(e & (s == "running"), "running").when(e & (s == "skipped"), "skipped").when(e, "missing").otherwise("unexpected")
    )
    return all_.select(*keys, r.alias("rows"), rule.alias("coverage"))


def parity(source: DataFrame, outputs: dict[str, DataFrame]) -> DataFrame:
    """Rows of each output beside its source's, and whether they agree: the outputs that should keep every row once."""
    n = source.agg(F.count(F.lit(1)).alias("source_rows"))
    out = None
    for name, df in outputs.items():
        one = df.agg(F.count(F.lit(1)).alias("output_rows")).join(F.broadcast(n)).select(F.lit(name).alias("output"), "source_rows", "output_rows", (F.col("source_rows") == F.col("output_rows")).alias("ok"))
        out = one if out is None else out.unionByName(one)
    return out


def quality_scores(results: DataFrame) -> DataFrame:
    """Each table's checks, failures by layer and score (share of passed checks x 100).

    results: table, layer, check, passed.
    """
    bad = F.col("bad")
    by_layer = results.groupBy("table", "layer").agg(F.count(F.lit(1)).alias("checks"), F.count_if(~F.coalesce("passed", F.lit(False))).alias("bad"), F.sort_array(F.collect_list(F.when(~F.coalesce("passed", F.lit(False)), F.col("check")))).alias("names"))
    return by_layer.groupBy("table").agg(
        F.sum("checks").alias("checks"), F.sum("bad").alias("failed"), (F.try_divide(F.sum(F.col("checks") - bad) * 100, F.sum("checks"))).alias("score"),
        F.concat_ws(",", F.sort_array(F.collect_list(F.when(bad > 0, F.concat_ws(":", "layer", F.concat_ws("+", "names")))))).alias("failures"),
    )


def anchors(counts: DataFrame, domains: DataFrame) -> DataFrame:
    """Whether each domain has one of its anchor tables: ok if any has rows, empty if some are there without rows, else missing.

    counts: name, n (a row for each table that is there); domains: domain, name.
    """
    x = domains.join(counts, "name", "left").groupBy("domain").agg(F.count("name").alias("anchors"), F.count("n").alias("present"), F.coalesce(F.max("n"), F.lit(0)).alias("most"))
    return x.select("domain", "anchors", "present", F.when(F.col("most") > 0, "ok").when(F.col("present") > 0, "empty").otherwise("missing").alias("status"))


def schema_versions(columns: DataFrame, keys: list[str], at: str, allowed: Column | None = None) -> DataFrame:
    """The history of each table's schema: a row for each observation, its hash, version, and the columns added and removed since the
    last one; refused where some were removed that are not allowed to go.

    columns: keys, at, column, type (a row for each column of an observed schema). allowed: a condition on the row.
    """
    one = columns.groupBy(*keys, at).agg(F.sort_array(F.collect_set(F.concat_ws(":", "column", "type"))).alias("cols"))
    w = Window.partitionBy(*keys).orderBy(at)
    x = one.withColumn("hash", F.sha2(F.concat_ws("|", "cols"), 256)).withColumn("was", F.lag("cols").over(w)).withColumn("old", F.lag("hash").over(w))
    x = x.withColumn("changed", F.col("old").isNull() | (F.col("old") != F.col("hash")))
    x = x.withColumn("version", F.count_if("changed").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    x = x.withColumn("drifted", F.col("hash") != F.first("hash").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    x = x.withColumn("added", F.when(F.col("was").isNotNull(), F.array_except("cols", "was"))).withColumn("removed", F.when(F.col("was").isNotNull(), F.array_except("was", "cols")))
    gone = F.coalesce(F.size("removed") > 0, F.lit(False))
    return x.withColumn("refused", gone & ~(allowed if allowed is not None else F.lit(False))).drop("was", "old")


def inferred_keys(columns: list[str], named: tuple[str, ...] = ("game_id", "player_id", "team_id", "event_num"), suffixes: tuple[str, ...] = ("_id",), most: int = 4) -> list[str]:
    """A table's likely key by convention: the named columns that it has, else its first columns with a key suffix."""
    return ([c for c in named if c in columns] or [c for c in columns if c.endswith(suffixes)])[:most]


def stat_columns(df: DataFrame, suffixes: tuple[str, ...] = ("_id",), most: int = 15) -> list[str]:
    """The first numeric columns that aren't keys."""
    numeric = [c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")]
    return [c for c in numeric if not c.endswith(suffixes)][:most]


def schema_checks(tables: dict[str, DataFrame], critical: set[str], facts: set[str], suffixes: tuple[str, ...] = ("_id",), named: tuple[str, ...] = (), zero_share: float = 0.05, least_stats: int = 5) -> DataFrame:
    """Checks made from each table's schema, one aggregation a table: nulls in critical columns, rows beyond the first of each inferred key, and, for fact tables with
    at least five statistics, rows in which the first 15 of them are all zero or null.

    table, check, columns, n (rows that break it), total, severity: error for over 1 % null keys, warning for fewer and for repeated
    keys, info for over zero_share of all-zero rows; null where there is nothing to report.
    """
    out = None
    for name, df in tables.items():
        total, checks = F.count(F.lit(1)), []
        for col in sorted(critical & set(df.columns)):
            n = F.count_if(F.col(col).isNull())
            checks.append(("null_key_column", col, n, F.when(n > 0.01 * total, "error").when(n > 0, "warning")))
        keys = inferred_keys(df.columns, named, suffixes)
        if keys:
            n = total - F.count_distinct(F.struct(*keys))
            checks.append(("duplicate_keys", ",".join(keys), n, F.when(n > 0, "warning")))
        stats = stat_columns(df, suffixes)
        if name in facts and len(stats) >= least_stats:
            zero = F.lit(True)
            for col in stats:
                zero = zero & (F.coalesce(F.col(col), F.lit(0)) == 0)
            n = F.count_if(zero)
            checks.append(("zero_stat_rows", ",".join(stats), n, F.when(n > zero_share * total, "info")))
        if not checks:
            continue
        one = df.agg(total.alias("total"), *(F.struct(F.lit(check).alias("check"), F.lit(cols).alias("columns"), n.cast("long").alias("n"), severity.alias("severity")).alias(f"c{k}") for k, (check, cols, n, severity) in enumerate(checks)))
        one = one.select("total", F.explode(F.array(*(f"c{k}" for k in range(len(checks))))).alias("c")).select(F.lit(name).alias("table"), "c.check", "c.columns", "c.n", "total", "c.severity")
        out = one if out is None else out.unionByName(one)
    return out


def coverage_status(expected: DataFrame, actual: DataFrame, journal: DataFrame, tables: DataFrame) -> DataFrame:
    """What is there of each expected table, season and type, by the first rule that holds.

    expected: table, endpoint, season, type (null: any), staged; actual: table, season, type, rows; journal: endpoint, season, type, item, attempt, status, rows (the last
    attempt of an item counts); tables: table, has_season, has_type, rows, a row for each table that is there. A typed scope that has no
    journal entry takes its season's entries, and a table without a type column its season's rows.
    """
    last = journal.groupBy("endpoint", "season", "type", "item").agg(F.max_by(F.struct("status", "rows"), "attempt").alias("e")).select("endpoint", "season", "type", "e.*")
    marks = ("done", "failed", "running", "abandoned")
    count = [F.count_if(F.col("status") == m).alias(m) for m in marks] + [F.sum("rows").alias("extracted")]
    both = lambda p: [F.col(m).alias(f"{p}_{m}") for m in (*marks, "extracted")]
    exact_j = last.groupBy("endpoint", "season", F.col("type").alias("t")).agg(*count).select("endpoint", "season", F.col("t").alias("type"), *both("x"))
    any_j = last.groupBy("endpoint", "season").agg(*count).select("endpoint", "season", *both("s"))
    exact_a = actual.groupBy("table", "season", "type").agg(F.sum("rows").alias("x_rows"))
    any_a = actual.groupBy("table", "season").agg(F.sum("rows").alias("s_rows"))
    x = expected.join(exact_a, ["table", "season", "type"], "left").join(any_a, ["table", "season"], "left")
    x = x.join(exact_j, ["endpoint", "season", "type"], "left").join(any_j, ["endpoint", "season"], "left")
    x = x.join(tables.withColumnRenamed("rows", "table_rows").withColumn("exists", F.lit(True)), "table", "left")
    typed, season_rows = F.col("type").isNotNull(), F.coalesce("s_rows", F.lit(0))
    own = typed & F.col("x_done").isNotNull()
    of = {m: F.coalesce(F.when(own, F.col(f"x_{m}")).otherwise(F.col(f"s_{m}")), F.lit(0)) for m in (*marks, "extracted")}
    rows = F.when(typed, F.coalesce("x_rows", F.lit(0))).otherwise(season_rows)
    untyped = typed & ~F.coalesce("has_type", F.lit(False)) & (season_rows > 0)
    guessed = ~F.coalesce("has_season", F.lit(False)) & (F.coalesce("table_rows", F.lit(0)) > 0) & (of["done"] > 0) & (of["extracted"] > 0)
    status = (
        F.when(~F.coalesce("staged", F.lit(False)), "contract_gap").when(F.col("exists").isNull(), "missing_table").when(rows > 0, "present").when(untyped, "present_untyped").when(guessed, "present_inferred")
        .when(of["done"] > 0, "empty_valid").when(of["failed"] > 0, "failed").when(of["running"] > 0, "running").when(of["abandoned"] > 0, "abandoned").otherwise("missing")
    )
    found = F.when(status == "present_untyped", season_rows).when(status == "present_inferred", of["extracted"]).otherwise(rows)
    scope = F.when(status == "present_untyped", "season_without_type").when(status == "present_inferred", "journal").when(typed, "season_type").otherwise("season")
    return x.select("table", "season", "type", status.alias("status"), found.alias("rows"), scope.alias("scope"))


def work_plan(pairs: DataFrame, item: str, season: str, kind: str, shards: int) -> DataFrame:
    """Work of each item (for example a player): seasons that need exactly the same types go together, and items are dealt into shards of near-equal load.

    item, types and seasons (comma-separated), load (pairs of the group), shard. Items are numbered by load (largest first, then by item) without
    a one-task sort, and dealt there and back over the shards, so that loads differ by at most one item's.
    """
    by_season = pairs.select(item, season, kind).dropna().groupBy(item, season).agg(F.array_join(F.sort_array(F.collect_set(F.col(kind).cast("string"))), ",").alias("types"), F.count_distinct(kind).alias("n"))
    groups = by_season.groupBy(item, "types").agg(F.array_join(F.transform(F.sort_array(F.collect_list(season)), lambda s: s.cast("string")), ",").alias("seasons"), F.sum("n").alias("load"))
    loads = groups.groupBy(item).agg((-F.sum("load")).alias("_less"))
    k = dense_key(loads, ["_less", item], "_k").select(item, (F.col("_k") - 1).alias("_k"))
    lap, spot = F.floor(F.col("_k") / shards), F.col("_k") % shards
    shard = F.when(lap % 2 == 0, spot).otherwise(shards - 1 - spot)
    return groups.join(k.select(item, shard.cast("int").alias("shard")), item)
