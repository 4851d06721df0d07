"""N-gram Jaccard self-join by vertical partitioning, and its components.

1. Documents of one word sequence form a class; only its smallest doc_id goes on.
2. Filter: in hash order, two sets of similarity t share at least l of their first n - ceil(t n) + l shingles, for any l. With l
   growing with n, a document goes on only if enough of these leading shingles occur in other documents. Runs packed by
   hash range count that without sending a row for each shingle.
3. What is left is ordered by document frequency, rarest first; shingles of one document drop out, which shortens the prefix
   that must be shared. Pairs come from shared prefix shingles: first each holder with the shingle's most central holder;
   then, between different components only, those of one centre in bounded blocks that emit nothing but links, and the other
   pairs one by one, or in such blocks too where many documents hold a shingle. A group of near copies is so joined by few rows.
4. Verification: the global order of n-grams is cut into fragments by ranges of the hash; each pair's overlaps are counted
   fragment by fragment and summed.

Similarity is at least MIN_PERCENT / 100: 100 |x and y| >= MIN_PERCENT |x or y|. Shingles are compared by 64-bit hashes.

Defined results: without words the set is empty and linked with nothing; with fewer words than a shingle, the whole
sequence is one; a document without doc_id has no component; rows that share a doc_id are separate documents of one
component; texts of any length are taken whole; an empty table gives an empty result; extra columns are ignored. Letters A-Z
are folded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm import _common, _text, runs
from tipoff.llm._text import U64
from tipoff.llm.components import components

SIZE, MIN_PERCENT, SLACK, FRAGMENTS = 5, 80, 10, 8
#: Documents in a block of those apart from their centre's component, of those that they meet, and shingles counted at a time.
NEAR_BLOCK, FAR_BLOCK, SLAB = 256, 1024, 4096
#: Holders of a leading shingle from which their pairs are found in blocks rather than as rows.
MANY_HOLDERS = 512
TABLES = _text.byte_table(90, fold_case=True), _text.byte_table(91, fold_case=True)
BASE, MULT = 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3


def shingles(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted by row, then hash; and their rows."""
    s, e, row = _text.word_bounds(data, offs)
    if len(s) == 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    w = _text.word_hashes(data, s, e, TABLES[0], BASE)
    g = _text.ngrams(w, SIZE, MULT)
    at = np.flatnonzero(row[SIZE - 1 :] == row[: len(g)])
    h, r = g[at], row[at]
    lim = _text.row_slices(row, len(offs) - 1)
    n = np.diff(lim)
    short = np.flatnonzero((n > 0) & (n < SIZE))
    if len(short):
        inside = np.repeat(short, n[short])
        pos = np.arange(len(inside)) - np.repeat(np.cumsum(n[short]) - n[short], n[short])
        x = w[np.repeat(lim[short], n[short]) + pos] * _text.powers(MULT, SIZE)[pos]
        whole = _text.mix(np.add.reduceat(x, np.cumsum(n[short]) - n[short]), 5)
        h, r = np.r_[h, whole], np.r_[r, short]
    o = np.lexsort((h, r))
    h, r = h[o], r[o]
    one = np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])]
    return h[one], r[one]


@_common.tidy
def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, a 128-bit hash of the folded word sequence and the number of shingles."""
    for b in batches:
        w1, w2, n = (np.zeros(b.num_rows, t) for t in (U64, U64, np.int64))
        for i, j, data, offs in _text.slices(b, "text"):
            s, e, row = _text.word_bounds(data, offs)
            _, r = shingles(data, offs)
            n[i:j] = np.bincount(r, minlength=j - i)
            docs, first = np.unique(row, return_index=True)
            if len(docs):
                pos = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
                p = _text.powers(MULT, int(pos.max()) + 1)[pos]
                for out, t in ((w1, TABLES[0]), (w2, TABLES[1])):
                    out[i + docs] = _text.mix(np.add.reduceat(_text.word_hashes(data, s, e, t, BASE) * p, first))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(n)], names=["doc_id", "w1", "w2", "n_shingles"])


def at_least(n, percent: int = MIN_PERCENT):
    """ceil(n * percent / 100) for integers."""
    return (n * percent + 99) // 100


@_common.tidy
def _map(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Runs of leading shingles; kind 1 rows count, for documents of one chunk, those that another of them has too."""
    held, n = [], 0

    def flush():
        h, d = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        o = np.argsort(h, kind="stable")
        h, d = h[o], d[o]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        size = np.diff(np.r_[first, len(h)])
        shared = np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first)
        rows = [(b, 0, *x) for b, *x in runs.pieces(h[first], d[first], shared.astype(np.int64), buckets)]
        docs, count = np.unique(d[np.repeat(shared, size)], return_counts=True)
        for b in np.unique(docs % buckets):
            k = docs % buckets == b
            rows.append((int(b), 1, runs.pack(docs[k]), runs.pack(count[k]), b""))
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "kind", "docs", "hashes", "who"])

    for b in batches:
        ids = b.column("doc_id").to_numpy(zero_copy_only=False)
        for i, j, data, offs in _text.slices(b, "text"):
            h, r = shingles(data, offs)
            size = np.bincount(r, minlength=j - i)
            lead = np.minimum(size, size - at_least(size) + 1 + size * SLACK // 100)
            rank = np.arange(len(r)) - (np.cumsum(size) - size)[r]
            k = rank < lead[r]
            if k.any():
                held.append((h[k], ids[i + r[k]]))
                n += int(k.sum())
            if n >= runs.CHUNK:
                yield flush()
                n = 0
    if held:
        yield flush()


@_common.tidied
def _reduce(key: tuple, pdf: pd.DataFrame, groups: int) -> pd.DataFrame:
    """How many of each document's leading shingles in this bucket occur in other documents, packed by group of documents."""
    docs, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    part, local = pdf[pdf.kind == 0], pdf[pdf.kind == 1]
    if len(part):
        h, d, many = (np.concatenate(x) for x in zip(*[runs.entries(*x) for x in zip(part.docs, part.hashes, part.who, strict=True)], strict=True))
        o = np.argsort(h, kind="stable")
        h, d, many = h[o], d[o], many[o]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        size = np.diff(np.r_[first, len(h)])
        other = np.repeat(size > 1, size) & (many == 0)  # documents of a shared entry were counted in their chunk
        u, c = np.unique(d[other], return_counts=True)
        docs.append(u)
        counts.append(c)
    for a, b in zip(local.docs, local.hashes, strict=True):
        docs.append(runs.unpack(a, np.int64))
        counts.append(runs.unpack(b, np.int64))
    u, n = summed(np.concatenate(docs), np.concatenate(counts))
    g = np.mod(u, groups)
    o = np.argsort(g, kind="stable")
    lim = np.r_[np.flatnonzero(np.r_[True, g[o][1:] != g[o][:-1]]), len(g)] if len(g) else np.zeros(1, np.int64)
    rows = [(int(g[o[a]]), runs.pack(u[o[a:b]]), runs.pack(n[o[a:b]])) for a, b in zip(lim[:-1], lim[1:], strict=True)]
    return pd.DataFrame(rows, columns=["g", "docs", "counts"])


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, inv = np.unique(keys, return_inverse=True)
    return u, np.bincount(inv, values, len(u)).astype(np.int64)


@_common.tidied
def _gather(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    u, n = summed(*(np.concatenate([runs.unpack(x, np.int64) for x in pdf[c]]) for c in ("docs", "counts")))
    return pd.DataFrame({"doc_id": u, "shared": n})


@_common.tidy
def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i, j, data, offs in _text.slices(b, "text"):
            h, r = shingles(data, offs)
            lists = pa.ListArray.from_arrays(pa.array(_text.row_slices(r, j - i).astype(np.int32)), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(i, j - i), lists], names=["rep", "toks"])


def ceil_percent(n: Column, percent: int = MIN_PERCENT) -> Column:
    return F.ceil(n * percent / F.lit(100)).cast("int")


def may_link(n1: Column, n2: Column, e1: Column, e2: Column) -> Column:
    """Sizes that allow similarity: e is how many of a set's n shingles any other candidate has."""
    need = F.ceil((n1 + n2) * MIN_PERCENT / F.lit(100 + MIN_PERCENT))
    return (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * MIN_PERCENT) & (F.least(e1, e2) >= need)


def verified(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar, by overlaps counted in fragments of the n-gram order and summed."""
    shift = 64 - FRAGMENTS.bit_length() + 1
    part = lambda f: F.filter("toks", lambda t: F.shiftright(t, shift) == f - FRAGMENTS // 2)
    frags = kept.select("rep", "n", F.posexplode(F.array(*(part(f) for f in range(FRAGMENTS)))).alias("f", "part"))
    left = frags.select(F.col("rep").alias("a"), F.col("n").alias("na"), "f", F.col("part").alias("pa"))
    right = frags.select(F.col("rep").alias("b"), F.col("n").alias("nb"), "f", F.col("part").alias("pb"))
    got = pairs.hint("merge").join(left.hint("merge"), "a").join(right.hint("merge"), ["b", "f"])
    got = got.groupBy("a", "b", "na", "nb").agg(F.sum(F.size(F.array_intersect("pa", "pb"))).alias("both"))
    return got.filter(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * MIN_PERCENT).select(F.col("a").alias("u"), F.col("b").alias("v"))


@_common.tidied
def _block_links(u: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
    """Links of two blocks of documents with one centre: for each document of u, one with each other component that it is similar to."""
    none = pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
    if not len(u) or not len(v):
        return none
    nu, nv = u.n.to_numpy(np.int64)[:, None], v.n.to_numpy(np.int64)[None, :]
    apart = u.component.to_numpy()[:, None] != v.component.to_numpy()[None, :]
    fit = apart & (np.minimum(nu, nv) * 100 >= np.maximum(nu, nv) * MIN_PERCENT) & (np.minimum(u.e.to_numpy()[:, None], v.e.to_numpy()[None, :]) * (100 + MIN_PERCENT) >= (nu + nv) * MIN_PERCENT)
    if not fit.any():
        return none
    sides = []
    for part in (u, v):
        tok = np.concatenate(part.toks.to_list())
        sides.append((tok, np.repeat(np.arange(len(part)), [len(x) for x in part.toks])))
    every = np.intersect1d(sides[0][0], sides[1][0])
    both = np.zeros(fit.shape, np.float32)
    at = [np.searchsorted(every, t) for t, _ in sides]
    hit = [(every[np.minimum(x, len(every) - 1)] == t) if len(every) else np.zeros(len(t), bool) for x, (t, _) in zip(at, sides, strict=True)]
    for lo in range(0, len(every), SLAB):
        m = []
        for x, h, (_, row), part in zip(at, hit, sides, (u, v), strict=True):
            k = h & (x >= lo) & (x < lo + SLAB)
            dense = np.zeros((len(part), min(SLAB, len(every) - lo)), np.float32)
            dense[row[k], x[k] - lo] = 1
            m.append(dense)
        both += m[0] @ m[1].T
    i, j = np.nonzero(fit & (both * 100 >= (nu + nv - both) * MIN_PERCENT))
    if not len(i):
        return none
    got = pd.DataFrame({"u": u.rep.to_numpy()[i], "v": v.rep.to_numpy()[j], "c": v.component.to_numpy()[j]})
    return got.drop_duplicates(["u", "c"])[["u", "v"]]


def same_centre_links(members: DataFrame, scratch: _common.Scratch) -> DataFrame:
    """Links between components among documents of one centre: those apart from the centre's component meet all others in bounded blocks.

    members: rep, n, e, toks, component, primary, apart. The block numbers are a table of their own, so that a join on a busy centre is
    one that Spark can split.
    """
    sizes = members.groupBy("primary").agg(F.count_if("apart").alias("f"), F.count(F.lit(1)).alias("m")).filter("f > 0 and m > 1")
    sizes = scratch.keep(sizes.select("primary", F.ceil(F.col("f") / NEAR_BLOCK).cast("int").alias("fb"), F.ceil(F.col("m") / FAR_BLOCK).cast("int").alias("mb")), "sizes")
    d = members.hint("merge").join(sizes.hint("merge"), "primary")
    cols = ["primary", "rep", "n", "e", "toks", "component"]
    here = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    u = d.filter("apart").select(*cols, here("fb").alias("ub"), every("mb").alias("vb"))
    v = d.select(*cols, here("mb").alias("vb"), every("fb").alias("ub")).toDF(*(f"{c}_" for c in [*cols, "vb", "ub"])).select(*(F.col(f"{c}_").alias(c) for c in [*cols, "vb", "ub"]))
    key = ["primary", "ub", "vb"]
    return u.groupBy(*key).cogroup(v.groupBy(*key)).applyInPandas(lambda a, b: _block_links(a, b), "u long, v long")


def similar_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    spark = docs.sparkSession
    _common.ship(spark)
    scratch = _common.Scratch(spark)
    docs = _common.columns(docs, doc_id="long", text="string")
    buckets = runs.n_buckets(docs)
    groups = runs.groups_of(buckets)
    seen = scratch.keep(docs.mapInArrow(_digests, "doc_id long, w1 long, w2 long, n_shingles long"), "digests")
    real = seen.filter("doc_id is not null and n_shingles > 0")
    classes = scratch.keep(real.groupBy("w1", "w2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size")), "classes")
    counted = docs.filter("doc_id is not null").mapInArrow(lambda it: _map(it, buckets), runs.PIECE).groupBy("bucket").applyInPandas(lambda k, p: _reduce(k, p, groups), "g long, docs binary, counts binary")
    counted = counted.groupBy("g").applyInPandas(lambda k, p: _gather(k, p), "doc_id long, shared long")
    n = F.col("n_shingles")
    # of the leading shingles, at least 1 + floor(SLACK% of the smallest similar size) must occur elsewhere
    cand = classes.join(counted.hint("merge"), classes["rep"] == counted["doc_id"]).filter(F.col("shared") >= 1 + F.floor(ceil_percent(n) * SLACK / 100)).select("rep")
    cand = scratch.keep(cand, "candidates")
    scratch.free()
    sets = docs.join(cand.select(F.col("rep").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi").mapInArrow(_sets, "rep long, toks array<long>")
    sets = scratch.keep(sets.filter(F.size("toks") > 0), "sets")
    scratch.free()
    rows = sets.select("rep", F.size("toks").alias("n"), F.explode("toks").alias("tok"))
    df = rows.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    kept = rows.join(df.hint("merge"), "tok").groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("x"))
    kept = kept.filter(F.size("x") >= ceil_percent(F.col("n"))).select("rep", "n", F.size("x").alias("e"), F.col("x.tok").alias("toks"))
    kept = scratch.keep(kept, "kept")
    scratch.drop(sets)
    scratch.free()
    sig = kept.select("rep", "n", "e", F.explode(F.slice("toks", F.lit(1), F.col("e") - ceil_percent(F.col("n")) + 1)).alias("tok"))
    centre = sig.groupBy("tok").agg(F.max(F.struct((F.col("e") / F.col("n")).alias("r"), (-F.col("rep")).alias("c"), F.col("n").alias("cn"), F.col("e").alias("ce"))).alias("m")).select("tok", (-F.col("m.c")).alias("c"), "m.cn", "m.ce")
    star = sig.join(centre.hint("merge"), "tok").filter("rep <> c").filter(may_link(F.col("n"), F.col("cn"), F.col("e"), F.col("ce"))).select("rep", "c").distinct()
    star = scratch.keep(star, "stars")
    first = star.select(F.least("rep", "c").alias("a"), F.greatest("rep", "c").alias("b")).distinct()
    links = scratch.keep(verified(first, kept), "links")
    comps = components(links, scratch)
    # a document's primary centre is the one that most documents share; a centre of more than its own centres have is its own
    reach = scratch.keep(star.groupBy("c").agg(F.count(F.lit(1)).alias("reach")), "reach")
    best = star.hint("merge").join(reach.hint("merge"), "c").groupBy("rep").agg(F.max(F.struct("reach", (-F.col("c")).alias("c"))).alias("m"))
    place = kept.select("rep").join(comps.select(F.col("node").alias("rep"), "component").hint("merge"), "rep", "left").join(best.hint("merge"), "rep", "left")
    place = place.join(reach.withColumnRenamed("reach", "own").withColumnRenamed("c", "rep").hint("merge"), "rep", "left")
    primary = F.when(F.coalesce("m.reach", F.lit(0)) > F.coalesce("own", F.lit(0)), -F.col("m.c")).otherwise(F.col("rep"))
    place = scratch.keep(place.select("rep", F.coalesce("component", "rep").alias("component"), primary.alias("primary")), "places")
    at = place.select(F.col("rep").alias("primary"), F.col("component").alias("pc"))
    place = scratch.keep(place.hint("merge").join(at.hint("merge"), "primary", "left").select("rep", "component", "primary", (F.col("component") != F.coalesce("pc", "primary")).alias("apart")), "places")
    members = scratch.keep(kept.join(place.hint("merge"), "rep"), "members")
    near = scratch.keep(same_centre_links(members, scratch), "links")
    held = scratch.keep(sig.join(place.drop("apart").hint("merge"), "rep"), "held")
    # shingles that documents of different components and centres hold
    mixed = held.groupBy("tok").agg(F.count(F.lit(1)).alias("m"), *(f(c).alias(f"{k}_{c}") for c in ("component", "primary") for k, f in (("lo", F.min), ("hi", F.max))))
    mixed = scratch.keep(mixed.filter("lo_component <> hi_component and lo_primary <> hi_primary").select("tok", "m"), "mixed")
    held = scratch.keep(held.hint("merge").join(mixed.hint("merge"), "tok"), "held")
    busy = held.filter(F.col("m") > MANY_HOLDERS)
    if not busy.isEmpty():
        main = busy.groupBy("tok", "component").agg(F.count(F.lit(1)).alias("c")).groupBy("tok").agg(F.max_by("component", F.struct("c", "component")).alias("main"))
        main = scratch.keep(main, "main")
        busy = busy.hint("merge").join(main.hint("merge"), "tok").select("rep", F.col("tok").alias("primary"), "component", (F.col("component") != F.col("main")).alias("apart"))
        near = near.unionByName(scratch.keep(same_centre_links(scratch.keep(kept.join(busy.hint("merge"), "rep"), "members"), scratch), "links"))
    held = held.filter(F.col("m") <= MANY_HOLDERS)
    x, y = held.alias("x"), held.alias("y")
    rest = x.hint("merge").join(y, (F.col("x.tok") == F.col("y.tok")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.component") != F.col("y.component")) & (F.col("x.primary") != F.col("y.primary")) & may_link(F.col("x.n"), F.col("y.n"), F.col("x.e"), F.col("y.e")))
    rest = rest.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct().join(first.hint("merge"), ["a", "b"], "left_anti")
    rest = scratch.keep(rest, "pairs")
    more = scratch.keep(near.unionByName(verified(rest, kept)), "links")
    if not more.isEmpty():
        comps = components(links.unionByName(more), scratch)
    comps = scratch.keep(comps.select(F.col("node").alias("rep"), "component"), "components")
    scratch.close(seen, classes, comps)
    named = classes.filter("size > 1").select("w1", "w2", F.col("n_shingles").alias("ns"), F.col("rep").alias("class_rep"))
    out = real.join(named.hint("merge"), (real["w1"] == named["w1"]) & (real["w2"] == named["w2"]) & (real["n_shingles"] == named["ns"]), "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("class_rep", "doc_id").alias("rep")).join(comps.hint("merge"), "rep", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    return out.unionByName(seen.filter("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of the smallest doc_id of each component, all columns kept; rows without doc_id stay.

    Of several rows with the smallest doc_id, the one of the smallest text hash stays; they are combined before they are shuffled.
    """
    found = similar_components(docs)
    marks = found.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("doc_id") != F.col("component_id")).alias("gone"), F.count(F.lit(1)).alias("rows"), F.max("n_shingles").alias("n"))
    marks = marks.filter("gone or rows > 1 and n > 0").select(F.col("doc_id").alias("_one_id"), F.col("gone").alias("_one_gone"))
    marked = docs.join(marks.hint("merge"), docs["doc_id"] == F.col("_one_id"), "left")
    row = F.struct(*(docs[c] for c in docs.columns))
    several = marked.filter("not _one_gone").groupBy("_one_id").agg(F.min_by(row, F.xxhash64(docs["text"])).alias("_one_row"))
    return marked.filter("_one_id is null").select(*docs.columns).unionByName(several.select("_one_row.*"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(_common.table(spark, sf_dir, "documents"))


QUERIES = {"op9_ngram_join": op9_ngram_join}
ORACLE: dict[str, str] = {}
