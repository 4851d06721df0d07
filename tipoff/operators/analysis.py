"""Analysis jobs: comparisons, breakouts, projections, intervals, tests, similarity, clustering, curves, predictions."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tipoff.operators import windows as W
from tipoff.sources import sinks

#: Values or ranges of a column that trees tell apart (Spark's maxBins).
BINS = 32


def with_average(df: DataFrame, name: str, metrics: list[str], label: str = "average") -> DataFrame:
    """The rows and one more with the mean of each metric."""
    return df.select(name, *metrics).unionByName(df.agg(*(F.avg(m).alias(m) for m in metrics)).withColumn(name, F.lit(label)))


def breakouts(df: DataFrame, keys: list[str], value: str, sigma: float, least: int) -> DataFrame:
    """Rows at least sigma deviations above their key's mean, for keys with enough rows."""
    w = Window.partitionBy(*keys)
    d = df.withColumn("_n", F.count(value).over(w)).withColumn("_m", F.avg(value).over(w)).withColumn("_s", F.stddev_samp(value).over(w))
    return d.filter((F.col("_n") >= least) & (F.col("_s") > 0) & (F.col(value) >= F.col("_m") + sigma * F.col("_s"))).withColumn("sigmas", (F.col(value) - F.col("_m")) / F.col("_s")).drop("_n", "_m", "_s")


def projection(total: Column, games: Column, season: int = 82) -> tuple[Column, Column, Column]:
    """A season's projected total with a band of 1.96 root-variance, the rest of the season counted as Poisson."""
    rest = F.greatest(F.lit(season) - games, F.lit(0)) * F.try_divide(total, games)
    return total + rest, total + rest - 1.96 * F.sqrt(rest), total + rest + 1.96 * F.sqrt(rest)


def wilson(makes: Column, attempts: Column, confidence: float = 0.95) -> tuple[Column, Column]:
    """Wilson interval of a share."""
    z = NormalDist().inv_cdf(0.5 + confidence / 2)
    n, p = attempts.cast("double"), F.try_divide(makes.cast("double"), attempts.cast("double"))
    mid, half = (p + z * z / (2 * n)) / (1 + z * z / n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n)
    return mid - half, mid + half


def moments(df: DataFrame, group: str, a: str, b: str, value: str) -> DataFrame:
    """One row: size, mean and sample variance of two groups (na, ma, va, nb, mb, vb)."""
    of = lambda f, g: f(F.when(F.col(group) == g, F.col(value)))
    return df.agg(*(of(f, g).alias(n + k) for k, g in (("a", a), ("b", b)) for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))))


def welch(df: DataFrame, group: str, a: str, b: str, value: str) -> DataFrame:
    """Welch's t, its degrees of freedom, and Cohen's d of two groups, from moments."""
    s = moments(df, group, a, b, value)
    ea, eb = F.col("va") / F.col("na"), F.col("vb") / F.col("nb")
    pooled = F.sqrt(((F.col("na") - 1) * F.col("va") + (F.col("nb") - 1) * F.col("vb")) / (F.col("na") + F.col("nb") - 2))
    diff = F.col("ma") - F.col("mb")
    return s.select((diff / F.sqrt(ea + eb)).alias("t"), ((ea + eb) ** 2 / (ea**2 / (F.col("na") - 1) + eb**2 / (F.col("nb") - 1))).alias("dof"), (diff / pooled).alias("cohen_d"))


def rank_sum(df: DataFrame, group: str, a: str, b: str, value: str) -> DataFrame:
    """Mann-Whitney U of group a, sizes, and the tie term (sum of t^3 - t). Average ranks come from counts of each distinct value, added up over ranges of values."""
    n = df.filter(F.col(group).isin(a, b)).groupBy(value).agg(F.count_if(F.col(group) == a).alias("na"), F.count_if(F.col(group) == b).alias("nb"))
    below = W.global_running(n.withColumn("c", F.col("na") + F.col("nb")), [value], F.col("c"), "upto")
    r = below.withColumn("rank", F.col("upto") - (F.col("c") - 1) / 2)
    t = F.col("c").cast("double")
    return r.agg((F.sum(F.col("na") * F.col("rank")) - F.sum("na") * (F.sum("na") + 1) / 2).alias("u"), F.sum("na").alias("na"), F.sum("nb").alias("nb"), F.sum(t * t * t - t).alias("ties"))


def streaks(df: DataFrame, keys: list[str], order: list[Column], outcome: str) -> DataFrame:
    """Longest success streak, runs and expected runs (Wald-Wolfowitz) of each key; outcome is 0 or 1."""
    runs = W.islands(df, keys, order, outcome).groupBy(*keys, "island", outcome).agg(F.count(F.lit(1)).alias("len"))
    s = runs.groupBy(*keys).agg(F.max(F.when(F.col(outcome) == 1, F.col("len")).otherwise(0)).alias("longest"), F.count(F.lit(1)).alias("runs"), F.sum(F.when(F.col(outcome) == 1, F.col("len")).otherwise(0)).alias("n1"), F.sum(F.when(F.col(outcome) == 0, F.col("len")).otherwise(0)).alias("n0"))
    return s.withColumn("expected_runs", F.try_divide(2.0 * F.col("n1") * F.col("n0"), F.col("n1") + F.col("n0")) + 1)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def similar_to(df: DataFrame, id_col: str, vec: str, target, n: int = 10) -> DataFrame:
    """The n rows of largest cosine to one row; that row's vector is the only thing sent to all."""
    v = df.select(id_col, F.col(vec).cast("array<double>").alias("v"))
    one = v.filter(F.col(id_col) == target).select(F.col("v").alias("t")).limit(1)
    got = v.filter(F.col(id_col) != target).join(F.broadcast(one)).withColumn("cosine", F.try_divide(dot(F.col("v"), F.col("t")), F.sqrt(dot(F.col("v"), F.col("v"))) * F.sqrt(dot(F.col("t"), F.col("t")))))
    return got.select(id_col, "cosine").orderBy(F.desc("cosine"), id_col).limit(n)


def similar_by_distance(df: DataFrame, id_col: str, metrics: list[str], target, n: int = 10, position: str | None = None) -> DataFrame:
    """The n rows of largest 1 / (1 + d) to one row, d over z-scores of the metrics: Euclidean, or, with a position, the sum of
    absolute differences with the position as a one-hot of weight 0.5. One row of means and deviations and the target go to all."""
    m = df.agg(*(f(x).alias(f"_{k}{i}") for i, x in enumerate(metrics) for k, f in (("m", F.avg), ("s", F.stddev_samp))))
    z = [F.coalesce(F.try_divide(F.col(x) - F.col(f"_m{i}"), F.col(f"_s{i}")), F.lit(0.0)) for i, x in enumerate(metrics)]
    zs = df.join(F.broadcast(m)).select(id_col, F.array(*z).alias("z"), (F.col(position) if position else F.lit(None)).alias("pos"))
    one = zs.filter(F.col(id_col) == target).select(F.col("z").alias("t"), F.col("pos").alias("tpos")).limit(1)
    gap = F.zip_with("z", "t", lambda x, y: x - y)
    if position:
        d = F.aggregate(gap, F.lit(0.0), lambda s, x: s + F.abs(x)) + F.when(F.col("pos").eqNullSafe(F.col("tpos")), 0.0).otherwise(1.0)
    else:
        d = F.sqrt(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x))
    got = zs.filter(F.col(id_col) != target).join(F.broadcast(one)).select(id_col, (1 / (1 + d)).alias("similarity"))
    return got.orderBy(F.desc("similarity"), id_col).limit(n)


def _best_edges(a: pd.DataFrame, b: pd.DataFrame, n: int) -> pd.DataFrame:
    """The n best cosines of each vector of a block with those of another; near-ties are settled on sums in one order, then by id."""
    if not len(a) or not len(b):
        return pd.DataFrame({"src": a.id[:0], "dst": b.id[:0], "cosine": np.zeros(0)})
    b = b.sort_values("id")
    unit = []
    for part in (a, b):
        x = np.stack(part.v.to_list()).astype(float)
        size = np.sqrt((x * x).sum(1, keepdims=True))
        unit.append(np.where(size > 0, x / np.where(size > 0, size, 1), np.nan))
    x, y = unit
    src, dst = a.id.to_numpy(), b.id.to_numpy()
    cos = np.where(np.isnan(c := x @ y.T), -2.0, c)  # without a direction: last
    cos[src[:, None] == dst[None, :]] = -np.inf
    limit = np.partition(cos, -n, axis=1)[:, -n] if cos.shape[1] > n else np.full(len(src), -np.inf)
    i, j = np.nonzero((cos >= limit[:, None] - 1e-9) & (cos > -np.inf))
    exact = (x[i] * y[j]).sum(1)
    o = np.lexsort((dst[j], np.where(np.isnan(exact), 2.0, -exact), i))
    i, j, exact = i[o], j[o], exact[o]
    first = np.arange(len(i)) - np.searchsorted(i, i) < n
    return pd.DataFrame({"src": src[i[first]], "dst": dst[j[first]], "cosine": exact[first]})


def similarity_edges(df: DataFrame, id_col: str, vec: str, group: str, block: int = 2048, n: int = 3) -> DataFrame:
    """Top n neighbours by cosine inside groups: blocks of about `block` vectors are multiplied, and each pair of blocks emits its n best
    for each vector, so no task gathers a group and no pair of vectors is a row. Vectors without a direction have null cosines."""
    v = df.select(F.col(id_col).alias("id"), F.col(group).alias("g"), F.col(vec).cast("array<double>").alias("v")).filter(F.col("v").isNotNull() & F.col("g").isNotNull())
    blocks = v.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    v = v.join(blocks, "g").withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    a = v.select("id", "v", "g", F.col("own").alias("ba"), every.alias("bb"))
    b = v.select("id", "v", "g", every.alias("ba"), F.col("own").alias("bb")).toDF("id_", "v_", "g_", "ba_", "bb_").toDF("id", "v", "g", "ba", "bb")
    kind = df.schema[id_col].dataType.simpleString()
    key = ["g", "ba", "bb"]
    pairs = a.groupBy(*key).cogroup(b.groupBy(*key)).applyInPandas(lambda x, y: _best_edges(x, y, n), f"src {kind}, dst {kind}, cosine double")
    pairs = pairs.withColumn("cosine", F.nullif("cosine", F.lit(float("nan"))))
    return W.first_of(pairs, ["src"], F.desc("cosine"), F.col("dst"), n=n)


#: Rows among which pivots are chosen.
SAMPLE = 2048


def _far_apart(x: np.ndarray, n: int) -> np.ndarray:
    """Up to n directions, each the farthest from those before it."""
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(n, len(x)) and nearest.min() < 1 - 1e-9:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    return x[chosen]


def _angles(batches, pivots: np.ndarray, kind: pa.DataType):
    """Unit vectors with their nearest pivot and the angle to it; rows without a direction have neither."""
    for b in batches:
        x = np.array(b.column("v").to_pylist(), float).reshape(b.num_rows, -1)
        size = np.sqrt((x * x).sum(1, keepdims=True))
        unit = x / np.where(size > 0, size, 1)
        cos = np.clip(unit @ pivots.T, -1, 1)
        p = cos.argmax(1)
        yield pa.RecordBatch.from_arrays([b.column("g"), b.column("id"), b.column("v"), pa.array(p.astype(np.int32)), pa.array(np.where(size[:, 0] > 0, np.arccos(cos[np.arange(len(p)), p]), np.nan))], names=["g", "id", "v", "p", "angle"])


def pruned_edges(df: DataFrame, id_col: str, vec: str, group: str, block: int = 2048, n: int = 3, pivots: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Top n neighbours by cosine inside groups, exactly as similarity_edges finds them, and the pairs of blocks (g, a, b, bound, looked).

    Vectors are dealt to their nearest pivot (directions that lie far apart, among at most SAMPLE rows of smallest hash; about one for each block, 64 to 1,024), ordered by their angle to it and cut into
    blocks, so that a block is a ring around its pivot. A block is first joined with itself; the largest angle that one of its vectors has
    to its n-th neighbour so far is the block's reach. By the triangle inequality of angles, the rings of two blocks bound the angle of any
    of their vectors from below: pairs of blocks whose bound lies beyond the reach hold no top n and are never joined. Vectors without
    a direction form blocks of their own, which every block of the group meets.
    """
    spark, kind = df.sparkSession, df.schema[id_col].dataType.simpleString()
    v = df.select(F.col(group).alias("g"), F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("v")).filter(F.col("v").isNotNull() & F.col("g").isNotNull())
    directed = v.filter(F.exists("v", lambda x: x != 0))
    some = [r.v for r in directed.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()]
    if not some:
        return similarity_edges(df, id_col, vec, group, block, n), spark.createDataFrame([], f"g {df.schema[group].dataType.simpleString()}, a long, b long, bound double, looked boolean")
    centre = _far_apart(np.array(some, float), pivots or min(1024, max(64, v.count() // block)))
    at = spark.createDataFrame([(i, row) for i, row in enumerate(centre.tolist())], "p int, at array<double>")
    placed = v.mapInArrow(lambda it: _angles(it, centre, None), f"g {df.schema[group].dataType.simpleString()}, id {kind}, v array<double>, p int, angle double")
    placed = placed.withColumn("p", F.when(F.isnan("angle"), -1).otherwise(F.col("p"))).withColumn("angle", F.when(~F.isnan("angle"), F.col("angle")).otherwise(0.0))
    numbered = W.dense_key(placed, ["g", "p", "angle", "id"], "k")
    first = numbered.groupBy("g", "p").agg(F.min("k").alias("k0"))
    x = sinks.written(numbered.join(first, ["g", "p"]).select("g", "id", "v", "p", "angle", (F.col("k0") * 1_000_000 + F.floor((F.col("k") - F.col("k0")) / block)).alias("b")))
    found = "src {0}, dst {0}, cosine double".format(kind)

    def own(rows: pd.DataFrame) -> pd.DataFrame:
        return _best_edges(rows, rows, n)

    inside = sinks.written(x.groupBy("g", "b").applyInPandas(lambda rows: own(rows).assign(b=rows.b.iloc[0] if len(rows) else 0), found + ", b long"))
    worst = inside.withColumn("cosine", F.nullif("cosine", F.lit(float("nan")))).groupBy("b", "src").agg(F.count("cosine").alias("m"), F.min("cosine").alias("c")).groupBy("b").agg(F.count_if(F.col("m") < n).alias("short"), F.min("c").alias("c"), F.count(F.lit(1)).alias("have"))
    rings = x.groupBy("g", "p", "b").agg(F.min("angle").alias("lo"), F.max("angle").alias("hi"), F.count(F.lit(1)).alias("size"))
    rings = rings.join(worst, "b", "left")
    whole = (F.col("p") >= 0) & (F.col("have") == F.col("size")) & (F.col("short") == 0)
    rings = sinks.written(rings.select("g", "p", "b", "lo", "hi", F.when(whole, F.acos(F.greatest(F.least("c", F.lit(1.0)), F.lit(-1.0)))).otherwise(math.pi).alias("reach")).join(F.broadcast(at), "p", "left"))
    a, z = (rings.select("g", *(F.col(k).alias(f"{k}_{s}") for k in ("b", "lo", "hi", "reach", "at"))) for s in "az")
    d = F.acos(F.greatest(F.least(dot(F.col("at_a"), F.col("at_z")), F.lit(1.0)), F.lit(-1.0)))
    gap = F.greatest(d - F.col("hi_a") - F.col("hi_z"), F.col("lo_a") - d - F.col("hi_z"), F.col("lo_z") - d - F.col("hi_a"), F.lit(0.0))
    gap = F.when(d.isNotNull(), gap)
    pairs = a.join(z, "g").filter("b_a <> b_z").select("g", F.col("b_a").alias("a"), F.col("b_z").alias("b"), F.coalesce(gap, F.lit(0.0)).alias("bound"), "reach_a")
    pairs = sinks.written(pairs.select("g", "a", "b", "bound", (F.col("bound") <= F.col("reach_a") + 1e-7).alias("looked")))
    open_ = pairs.filter("looked").select("a", "b")
    left = x.select("id", "v", F.col("b").alias("a")).join(open_, "a").select("id", "v", "a", "b")
    right = x.select("id", "v", "b").join(open_, "b").select("id", "v", "a", "b").toDF("id_", "v_", "a_", "b_").toDF("id", "v", "a", "b")
    across = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(lambda p, q: _best_edges(p, q, n), found)
    edges = inside.drop("b").unionByName(across).withColumn("cosine", F.nullif("cosine", F.lit(float("nan"))))
    return W.first_of(edges, ["src"], F.desc("cosine"), F.col("dst"), n=n), pairs


def _best_matches(batch_key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    return _best_edges(a, b, 1)


def best_matches(a: DataFrame, b: DataFrame, id_col: str, vec: str, block: int = 2048) -> DataFrame:
    """src, dst, cosine: for each row of a the most similar row of b (ties: the smaller id); blocks are multiplied, no pair of vectors is a row."""
    kind = a.schema[id_col].dataType.simpleString()
    na, nb = (max(1, -(-x.count() // block)) for x in (a, b))
    take = lambda x, n, name: x.select(F.col(id_col).alias("id"), F.col(vec).cast("array<double>").alias("v"), F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int").alias(name))
    x = take(a, na, "ba").withColumn("bb", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))))
    y = take(b, nb, "bb").withColumn("ba", F.explode(F.sequence(F.lit(0), F.lit(na - 1))))
    got = x.groupBy("ba", "bb").cogroup(y.groupBy("ba", "bb")).applyInPandas(_best_matches, f"src {kind}, dst {kind}, cosine double")
    return W.first_of(got.filter(~F.isnan("cosine")), ["src"], F.desc("cosine"), F.col("dst"))


def aligned_similarity(df: DataFrame, id_col: str, age: str, value: str, target, least: int = 2) -> DataFrame:
    """Mean absolute difference to a target over common ages, in units of the value's deviation."""
    sd = df.agg(F.stddev_samp(value).alias("sd"))
    t = df.filter(F.col(id_col) == target).select(age, F.col(value).alias("tv"))
    got = df.filter(F.col(id_col) != target).join(t, age).groupBy(id_col).agg(F.avg(F.abs(F.col(value) - F.col("tv"))).alias("d"), F.count(F.lit(1)).alias("ages")).filter(F.col("ages") >= least)
    return got.join(F.broadcast(sd)).select(id_col, "ages", F.try_divide(F.col("d"), F.col("sd")).alias("distance"))


def clusters(df: DataFrame, vec: str, ks: list[int], seed: int = 7) -> tuple[DataFrame, dict[int, float]]:
    """k-means on standardised vectors for several k; the assignment of the best silhouette, and all silhouettes."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector

    x = df.withColumn("_v", array_to_vector(F.col(vec).cast("array<double>")))
    x = StandardScaler(inputCol="_v", outputCol="_x", withMean=True).fit(x).transform(x)
    found = {k: KMeans(k=k, seed=seed, featuresCol="_x", predictionCol="cluster").fit(x).transform(x) for k in ks}
    score = {k: ClusteringEvaluator(featuresCol="_x", predictionCol="cluster").evaluate(d) for k, d in found.items()}
    return found[max(score, key=score.get)].drop("_v", "_x"), score


def mixtures(df: DataFrame, vec: str, ks: list[int], seed: int = 7) -> tuple[DataFrame, dict[int, tuple[float, float]]]:
    """Gaussian mixtures on standardised vectors for several k; the assignment of the least BIC, and BIC and silhouette of each k.

    BIC is -2 log likelihood + p ln n with p free parameters: weights, means and full covariances.
    """
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector

    x = df.withColumn("_v", array_to_vector(F.col(vec).cast("array<double>")))
    x = StandardScaler(inputCol="_v", outputCol="_x", withMean=True).fit(x).transform(x)
    found, score = {}, {}
    n, d = x.agg(F.count(F.lit(1)), F.max(F.size(vec))).collect()[0]
    for k in ks:
        model = GaussianMixture(k=k, seed=seed, featuresCol="_x", predictionCol="cluster", maxIter=50, tol=1e-3).fit(x)
        found[k] = model.transform(x)
        p = k - 1 + k * d + k * d * (d + 1) / 2
        sil = ClusteringEvaluator(featuresCol="_x", predictionCol="cluster").evaluate(found[k]) if found[k].select("cluster").distinct().count() > 1 else 0.0
        score[k] = (-2 * model.summary.logLikelihood + p * math.log(n), sil)
    return found[min(score, key=lambda k: score[k][0])].drop("_v", "_x", "probability"), score


def components_profile(df: DataFrame, vec: str, weights: tuple[float, ...] = (0.35, 0.35, 0.3)) -> DataFrame:
    """Principal components, each scaled to 0-100 with its sign fixed by the largest loading, and their weighted sum."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    x = df.withColumn("_v", array_to_vector(F.col(vec).cast("array<double>")))
    x = StandardScaler(inputCol="_v", outputCol="_x", withMean=True).fit(x).transform(x)
    model = PCA(k=len(weights), inputCol="_x", outputCol="_p").fit(x)
    load = model.pc.toArray()
    sign = [1.0 if load[abs(load[:, i]).argmax(), i] > 0 else -1.0 for i in range(len(weights))]
    p = model.transform(x).withColumn("_p", vector_to_array("_p"))
    p = p.select(*df.columns, *((F.col("_p")[i] * sign[i]).alias(f"pc{i}") for i in range(len(weights))))
    lim = p.agg(*(f(f"pc{i}").alias(f"{n}{i}") for i in range(len(weights)) for n, f in (("lo", F.min), ("hi", F.max))))
    p = p.join(F.broadcast(lim))
    score = [F.coalesce(F.try_divide((F.col(f"pc{i}") - F.col(f"lo{i}")) * 100, F.col(f"hi{i}") - F.col(f"lo{i}")), F.lit(0.0)) for i in range(len(weights))]
    return p.select(*df.columns, *(s.alias(f"score{i}") for i, s in enumerate(score)), sum((w * s for w, s in zip(weights, score, strict=True)), F.lit(0.0)).alias("composite"))


def peak_fit(curve: DataFrame, x: str, y: str, peaks: list[float], widths: list[float]) -> DataFrame:
    """Least-squares Gaussian a exp(-(x - peak)^2 / 2 width^2) + c over a grid of peaks and widths; a and c in closed form.

    curve holds one row for each bucket of x, so grid times curve is small.
    """
    grid = F.explode(F.array(*(F.struct(F.lit(float(p)).alias("peak"), F.lit(float(w)).alias("width")) for p in peaks for w in widths)))
    g = curve.select(F.col(x).cast("double").alias("x"), F.col(y).alias("y"), grid.alias("g")).select("x", "y", "g.*")
    g = g.withColumn("b", F.exp(-((F.col("x") - F.col("peak")) ** 2) / (2 * F.col("width") ** 2)))
    s = g.groupBy("peak", "width").agg(F.regr_slope("y", "b").alias("a"), F.regr_intercept("y", "b").alias("c"), F.regr_syy("y", "b").alias("syy"), F.regr_r2("y", "b").alias("r2"))
    return s.withColumn("sse", F.col("syy") * (1 - F.col("r2"))).orderBy("sse", "peak", "width").limit(1)


def few_values(df: DataFrame, season: str, features: list[str]) -> dict[str, list]:
    """The features of at most BINS values, with their (season, value) pairs."""
    n = df.agg(*(F.approx_count_distinct(f).alias(f) for f in features)).collect()[0]
    out = {}
    for f in features:
        if n[f] <= 2 * BINS:
            pairs = df.select(season, f).filter(F.col(season).isNotNull() & F.col(f).isNotNull()).distinct().collect()  # under 2 BINS or so a season
            if len({v for _, v in pairs}) <= BINS:
                out[f] = pairs
    return out


def walk_forward(df: DataFrame, season: str, features: list[str], label: str, seasons: list | None = None, least: int = 50) -> DataFrame:
    """For each season (all with at least three before it), a stacked model of all earlier ones; (season, label, probability).

    Boosted trees and a random forest of all earlier seasons, medians of their training rows filled in, predict every season from the
    second on. A logistic model of these predictions for the seasons before a season blends its two; with fewer than least of
    them it is their mean. So nothing is learned from a season that is predicted, or from a later one.

    Trees try at most BINS - 1 cuts of a column, so the earlier seasons are cut there first (at every value where there are few, else at
    quantiles) and rows that fall alike are one row of that weight: a tree's many passes don't grow with the rows.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import Bucketizer, VectorAssembler
    from pyspark.ml.functions import vector_to_array

    two = {"ml_attr": {"type": "nominal", "vals": ["0", "1"]}}  # also where the earlier seasons have one label only
    base_path = sinks.work_dir(df.sparkSession)

    def keep(frame: DataFrame, name: str) -> DataFrame:
        """Written, as every later season reads it; the label's kinds are told again."""
        frame.write.parquet(f"{base_path}/{name}")
        return frame.sparkSession.read.schema(frame.schema).parquet(f"{base_path}/{name}").withColumn(label, F.col(label).alias(label, metadata=two))

    values = [F.nanvl(F.col(f).cast("double"), F.lit(None)).alias(f) for f in features]
    df = keep(df.select(season, *values, F.col(label).cast("double").alias(label)), "games")
    sizes = {r[0]: r[1] for r in df.filter(F.col(season).isNotNull()).groupBy(season).count().orderBy(season).collect()}  # a row per season
    known = list(sizes)
    wanted = known[3:] if seasons is None else seasons
    folds = [s for s in known[1:] if any(s <= x for x in wanted)]
    few, filled = few_values(df, season, features), [f"_in_{f}" for f in features]
    assemble = VectorAssembler(inputCols=filled, outputCol="_x")
    quantiles = [k / BINS for k in range(1, BINS)]

    def fit(k: int) -> tuple[DataFrame, DataFrame]:
        """Both predictions of the k-th fold's season: of each row, and of rows that fall alike, with their weights."""
        past, here = df.filter(F.col(season) < folds[k]), df.filter(F.col(season) == folds[k])
        at = [q or [0.0] * len(quantiles) for q in past.approxQuantile(features, quantiles, 0.001)]
        medians = {f: q[BINS // 2 - 1] for f, q in zip(features, at, strict=True)}
        cuts = [sorted({v for s, v in few[f] if s < folds[k]} or {0.0}) if f in few else sorted(set(q)) for f, q in zip(features, at, strict=True)]
        bins = Bucketizer(inputCols=features, outputCols=filled, splitsArray=[[-math.inf, *c, math.inf] for c in cuts])

        def binned(frame: DataFrame) -> DataFrame:
            return bins.transform(frame.fillna(medians)).withColumns({f: F.col(f).cast("int") for f in filled})  # numbers, not the bucketizer's kinds

        def alike(frame: DataFrame) -> DataFrame:
            return binned(frame).groupBy(label, *filled).agg(F.count(F.lit(1)).cast("double").alias("_n"))

        train = keep(alike(past).sortWithinPartitions(label, *filled), f"train-{k}")
        trees = [m(featuresCol="_x", labelCol=label, weightCol="_n", seed=42, maxBins=BINS) for m in (GBTClassifier, RandomForestClassifier)]
        trees = [m.setProbabilityCol(f"_p{i}").setRawPredictionCol(f"_r{i}").setPredictionCol(f"_c{i}") for i, m in enumerate(trees)]
        model = Pipeline(stages=[assemble, *trees]).fit(train)

        both = [vector_to_array(f"_p{i}")[1].alias(f"_b{i}") for i in (0, 1)]
        rows = model.transform(binned(here)).select(season, label, *both)
        return rows, keep(model.transform(alike(here)).select(label, "_n", *both), f"predicted-{k}")

    with ThreadPoolExecutor(4) as pool:  # folds don't need each other's models
        base = dict(zip(folds, pool.map(inheritable_thread_target(df.sparkSession)(fit), range(len(folds))), strict=True))
    out = df.select(season, label, F.lit(0.0).alias("probability")).limit(0)
    for s in (x for x in folds if x in wanted):
        got, before = base[s][0], [x for x in folds if x < s]
        if sum(sizes[x] for x in before) < least:
            blend = got.select(season, label, ((F.col("_b0") + F.col("_b1")) / 2).alias("probability"))
        else:
            learned = base[before[0]][1]
            for x in before[1:]:
                learned = learned.unionByName(base[x][1])
            steps = [VectorAssembler(inputCols=["_b0", "_b1"], outputCol="_x"), LogisticRegression(featuresCol="_x", labelCol=label, weightCol="_n", probabilityCol="_pr", maxIter=1000)]
            learned = learned.withColumn(label, F.col(label).alias(label, metadata=two))  # a union drops it
            steps[1] = steps[1].fit(steps[0].transform(learned))
            for step in steps:
                got = step.transform(got)
            blend = got.select(season, label, vector_to_array("_pr")[1].alias("probability"))
        out = out.unionByName(blend)
    return out


def hex_bins(df: DataFrame, x: str, y: str, width: float, value: str, least: int = 1) -> DataFrame:
    """Hexagonal bins: the nearer of two offset grids of centres; count and mean of each bin with enough rows."""
    sx, sy = width, width * 3**0.5
    u, v = F.col(x) / sx, F.col(y) / sy
    a = (F.round(u), F.round(v))
    b = (F.floor(u) + 0.5, F.floor(v) + 0.5)
    da, db = (u - a[0]) ** 2 + 3 * (v - a[1]) ** 2, (u - b[0]) ** 2 + 3 * (v - b[1]) ** 2
    near = da < db
    d = df.select(F.when(near, a[0]).otherwise(b[0]).alias("hx"), F.when(near, a[1]).otherwise(b[1]).alias("hy"), F.col(value).alias("_v"))
    return d.groupBy("hx", "hy").agg(F.count(F.lit(1)).alias("n"), F.avg("_v").alias("mean")).filter(F.col("n") >= least)
