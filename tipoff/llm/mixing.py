"""Mixing sources to target weights.

Each source's words are packed into blocks of a fixed number of words. Output shards draw their source counts from a
multinomial, conditioned on the corpus-wide slot totals so that every source comes near its target; a slot is mapped
through its source's pseudorandom permutation of block indices (a new permutation on each pass over the source), and
slots join blocks by index. Only sizes and indices are shuffled, never texts.

Defined results: a null or empty text has size 0 and is never taken; a null source is a source of its own, last in
order; rows that share a doc_id are separate documents; equal rows are one document of several rows and may be taken unequally;
within a source, documents stand by stretch (a hash), doc_id (nulls first) and text hash; an empty table gives an empty
result; extra columns are ignored. A text of any length is one document of as many blocks as its words fill.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tipoff.llm import _common
from tipoff.llm._text import MASK, U64, mix

WEIGHTS, MAX_REPEATS = (5.0, 2.0, 1.0), 3
#: Words in a block, documents in one stretch of the sources' order, stretches summed together, documents by size in a stretch of copies.
BLOCK, STRETCH, COARSE, COPY_STRETCH, SEED = 32, 256, 16384, 4096, 20
#: Slots of one output shard, and the fewest shards (for parallel work on small corpora).
SHARD_SLOTS, MIN_SHARDS = 1 << 22, 64
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights: list[float], most: float = MAX_REPEATS) -> list[float]:
    """Shares of sum(sizes) by weight; what exceeds most * size is shared again by weight among the others."""
    total, out, free, left = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while free:
        w = sum(weights[i] for i in sorted(free))
        over = [i for i in sorted(free) if left * weights[i] / w > most * sizes[i]]
        if not over:
            for i in sorted(free):
                out[i] = left * weights[i] / w
            break
        for i in over:
            out[i] = float(most * sizes[i])
            free.discard(i)
        left = total - sum(out[i] for i in range(len(sizes)) if i not in free)
    return out


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 for each key: a four-round Feistel network over the next power of four, walked until inside."""
    half = np.maximum((np.ceil(np.log2(np.maximum(n, 2).astype(float))).astype(np.int64) + 1) // 2, 1).astype(U64)
    half = half + (((U64(1) << (half * U64(2))) < n.astype(U64)).astype(U64))
    low, x, todo = (U64(1) << half) - U64(1), i.astype(U64), np.arange(len(i))
    while len(todo):
        y, h, m, k = x[todo], half[todo], low[todo], key[todo]
        for r in range(4):
            left, right = y >> h, y & m
            y = (right << h) | ((left ^ mix(right ^ k, r)) & m)
        x[todo] = y
        todo = todo[y >= n[todo].astype(U64)]
    return x.astype(np.int64)


def draw(slots: list[int], shards: int, seed: int = SEED) -> np.ndarray:
    """Counts by shard and source: each shard's multinomial draw, conditioned on every source's slots being used up."""
    rng, left, out = np.random.default_rng(seed), np.array(slots, np.int64), np.zeros((shards, len(slots)), np.int64)
    for t in range(shards):
        want = int(left.sum()) // (shards - t)
        if t == shards - 1:
            out[t] = left
        else:
            got = rng.multinomial(want, left / max(1, left.sum()))
            got = np.minimum(got, left)
            while (short := want - int(got.sum())) > 0:
                room = left - got
                got += np.minimum(rng.multinomial(short, room / room.sum()), room)
            out[t] = got
        left = left - out[t]
    return out


def _slots(batches: Iterator[pd.DataFrame], seed: int, piece: int = 1 << 18) -> Iterator[pd.DataFrame]:
    """Blocks for each (shard, source, first slot, slots, blocks of the source)."""
    for pdf in batches:
        for s, first, n, blocks in zip(pdf.src, pdf["first"], pdf.n, pdf.blocks, strict=True):
            for a in range(first, first + n, piece):
                i = np.arange(a, min(a + piece, first + n), dtype=np.int64)
                key = mix(U64((int(s) * 0x9E3779B97F4A7C15 + seed) & MASK) + (i // blocks).astype(U64))
                got, times = np.unique(permuted(i % blocks, np.full(len(i), blocks, np.int64), key), return_counts=True)
                yield pd.DataFrame({"src": s, "block": got, "times": times})


def offsets(rows: DataFrame, by: str, value: str) -> DataFrame:
    """by, stretch and base: the sum of value over the earlier stretches of each `by`, in two levels so that no task takes over COARSE of them."""
    sums = rows.groupBy(by, "stretch").agg(F.sum(value).alias("s")).withColumn("coarse", F.floor(F.col("stretch") / COARSE))
    low = sums.groupBy(by, "coarse").agg(F.sum("s").alias("s"))
    before = lambda *keys: F.coalesce(F.sum("s").over(Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    low = low.select(by, "coarse", before(by, "coarse").alias("low"))
    inside = sums.select(by, "coarse", "stretch", before(by, "coarse", "stretch").alias("inside"))
    return inside.join(low, [by, "coarse"]).select(by, "stretch", (F.col("low") + F.col("inside")).alias("base"))


def row_tie() -> Column:
    """The hash that, with doc_id and source, tells rows of documents apart."""
    return F.xxhash64("doc_id", F.coalesce(F.col("text"), F.lit("")))


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MAX_REPEATS, block: int = BLOCK, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, size, source, source_size, target, taken (words of the document in the mix, repeats counted) and tie (hash of the row)."""
    spark = docs.sparkSession
    _common.ship(spark)
    scratch = _common.Scratch(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    sizes = _common.columns(docs, doc_id="long", source="string", text="string").select(
        "doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), row_tie().alias("tie")
    )
    sizes = scratch.keep(sizes, "sizes")
    per = sizes.groupBy("source").agg(F.sum("size").alias("w")).collect()  # a row per source
    per.sort(key=lambda r: (r.source is None, [ord(c) for c in r.source or ""]))
    goal = targets([r.w for r in per], [weights[i % len(weights)] for i in range(len(per))], most)
    blocks = [-(-r.w // block) for r in per]
    slots = [min(round(g / block), most * b) for g, b in zip(goal, blocks, strict=True)]
    slots = [max(n, 1) if b else 0 for n, b in zip(slots, blocks, strict=True)]
    shards = shards or max(MIN_SHARDS, -(-sum(slots) // SHARD_SLOTS))
    counts = draw(slots, shards, seed) if per else np.zeros((shards, 0), np.int64)
    first = np.cumsum(counts, 0) - counts
    plan = [(s, int(first[t, s]), int(counts[t, s]), blocks[s]) for t in range(shards) for s in range(len(per)) if counts[t, s]]
    sources = spark.createDataFrame([(i, r.source, int(r.w), float(g)) for i, (r, g) in enumerate(zip(per, goal, strict=True))], "src int, source string, source_size long, target double")
    taken_blocks = (
        spark.createDataFrame(plan, "src int, first long, n long, blocks long").repartition(shards)
        .mapInPandas(lambda it: _slots(it, seed), "src int, block long, times long")
        .groupBy("src", "block").agg(F.sum("times").alias("times"))
    )
    # Each document's place in its source: stretches by a hash of the id, summed first, so no source is gathered in a task.
    known = sizes.join(sources, sizes["source"].eqNullSafe(sources["source"])).select("doc_id", "tie", "size", sizes["source"], "src", "source_size", "target")
    n_stretches = max(1, sizes.count() // STRETCH)
    known = known.withColumn("stretch", F.pmod(F.xxhash64("doc_id", "tie"), F.lit(n_stretches)))
    starts = offsets(known, "src", "size")
    place = Window.partitionBy("src", "stretch").orderBy("doc_id", "tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = known.withColumn("to", F.sum("size").over(place)).withColumn("nth", F.count(F.lit(1)).over(place))
    placed = placed.join(starts, ["src", "stretch"]).withColumn("to", F.col("to") + F.col("base")).withColumn("from", F.col("to") - F.col("size"))
    pieces = placed.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block)))))
    here = F.least(F.col("to"), (F.col("block") + 1) * block) - F.greatest(F.col("from"), F.col("block") * block)
    return (
        pieces.join(taken_blocks.hint("merge"), ["src", "block"], "left")
        .groupBy("src", "stretch", "nth", "doc_id", "tie", "size", "source", "source_size", "target")
        .agg(F.sum(F.coalesce(here * F.col("times"), F.lit(0))).cast("long").alias("taken"))
        .select("doc_id", "size", "source", "source_size", "target", "taken", "tie")
    )


def copies(taken: DataFrame, n_docs: int, seed: int = SEED) -> DataFrame:
    """The rows' key (doc_id, source, size, tie) and copies: how many whole copies stand for the words that mix_sources took.

    copies is taken / size, rounded up or down by systematic draws along a source's documents in order of size (by quarters of a power
    of two): a document's copies are taken / size on average, and a source's words stay near those taken. Rows of one key share
    their taken words and count as one draw.
    """
    key = [c for c in ("doc_id", "source", "size", "tie") if c in taken.columns]
    per = taken.filter("size > 0").groupBy(*key).agg(F.count(F.lit(1)).alias("rows"), (F.sum("taken") / F.sum("size")).alias("share"))
    n, one = max(1, n_docs // COPY_STRETCH), 1 << 30
    weight = F.col("rows") * F.col("size")
    per = per.withColumn("stretch", F.floor(F.log2(weight) * 4) * n + F.pmod(F.xxhash64(*key), F.lit(n))).withColumn("of", F.xxhash64("source"))
    per = per.withColumn("part", F.floor((F.col("share") - F.floor("share")) * one))  # fixed point: sums don't depend on their order
    per = _common.Scratch(taken.sparkSession).keep(per, "shares")  # read twice below
    order = Window.partitionBy("of", "stretch").orderBy(weight, *key).rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("to", F.sum("part").over(order)).join(offsets(per, "of", "part"), ["of", "stretch"])
    start = F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(one)) + F.col("base")
    more = F.floor((F.col("to") + start) / one) - F.floor((F.col("to") - F.col("part") + start) / one)
    return per.select(*key, (F.floor("share") + more).cast("int").alias("copies"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_common.table(spark, sf_dir, "documents"))


QUERIES = {"op2_source_mix": op2_source_mix}
ORACLE: dict[str, str] = {}
