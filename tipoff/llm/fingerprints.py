"""I-Match document fingerprints, DataFrame functions only.

Terms (lower-cased words) whose document frequency lies in a chosen band form the lexicon. A document's distinct lexicon
terms, sorted, are hashed within several randomised lexicon subsets of different densities; the fingerprint is the list
of those hashes in hexadecimal, an empty subset giving '-'. Likeness of two fingerprints is the share of equal hashes
among the subsets that either document has terms in; sparse subsets make it graded, dense ones make it strict.

The lexicon is broadcast: a term must be in at least MIN_SHARE of the documents, so at most (mean distinct terms per
document) / MIN_SHARE terms qualify however large the corpus is. Texts are shuffled once, by ranges of (doc_id, text hash)
that hold about equally many rows whatever the ids look like; this puts each document beside the next one; boundary
documents are copied into the neighbouring range. Cuts are quantiles of a bounded sample of keys. There are at most
MAX_RANGES ranges; beyond that they grow, and as a range is sorted by Spark's external sort and then streamed, it need not
fit in memory.

Defined results: null texts are empty texts; a document without lexicon terms is fingerprinted by its whole text, so
equal texts always have equal fingerprints; likeness of two equal fingerprints is 1; a table of one document has itself
as the next one; documents without a doc_id come last in order; any 64-bit ids do; rows that share a doc_id are ordered by
text hash, and repeated rows give repeated results; texts of any length are taken whole; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tipoff.llm import _common

#: Document-frequency band as shares of the documents (idf from ln(1/MAX_SHARE) to ln(1/MIN_SHARE)).
MIN_SHARE, MAX_SHARE = 0.005, 0.25
#: (d, subsets): a term belongs to a subset of density 1/d with that probability; for d = 1 an eighth is left out.
SUBSETS = ((1, 2), (16, 6), (128, 20), (1024, 12))
#: Documents in a range of keys, the most ranges, and sampled keys for each range.
RANGE_DOCS, MAX_RANGES, PER_CUT = 2048, 65536, 16
WORD_BREAK = r"[\x20\x09-\x0D]+"


def terms(text: Column) -> Column:
    """Distinct lower-cased words (runs of characters other than space and 09-0D)."""
    return F.array_distinct(F.filter(F.split(F.lower(text), WORD_BREAK), lambda w: w != ""))


def lexicon(texts: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> DataFrame:
    """Hashes of the terms of the band; df and the number of documents cover every text."""
    total = texts.agg(F.count(F.lit(1)).alias("n_docs"))
    df = texts.select(F.explode(terms(F.col("text"))).alias("w")).select(F.xxhash64("w").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    inside = (F.col("df") >= F.greatest(F.lit(2), F.ceil(F.col("n_docs") * min_share))) & (F.col("df") <= F.ceil(F.col("n_docs") * max_share))
    return df.join(F.broadcast(total), how="cross").filter(inside).select("term")


def beside(docs: DataFrame) -> DataFrame:
    """Each document with the text of the next by descending doc_id; the last is followed by the first.

    Columns: rng, nth (order in the range), copy (1: a neighbour's first document, here only to be next), doc_id, text,
    next_text. The rows of a range are in one partition, in order.
    """
    n = docs.count()
    ranges = max(1, min(MAX_RANGES, n // RANGE_DOCS))
    # keys ascend as the order of documents descends: doc_id, then the complement of the text's hash
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    keyed = keyed.withColumn("key", F.struct("doc_id", F.bitwise_not("tie").alias("eit")))
    cuts = _common.bounded(keyed.select("key.*"), ranges * PER_CUT, "doc_id", "eit")  # at most MAX_RANGES * PER_CUT keys
    nth = F.row_number().over(Window.orderBy("doc_id", "eit"))
    cuts = cuts.withColumn("nth", nth).filter(F.col("nth") % PER_CUT == 0).agg(F.sort_array(F.collect_list(F.struct("doc_id", "eit"))).alias("cuts"))
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(ranges.bit_length()))))
    # binary search: how many cuts the key has reached
    reached = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= F.size("cuts")) & (F.try_element_at("cuts", at + step) <= F.col("key")), at + step).otherwise(at))
    placed = keyed.join(F.broadcast(cuts), how="cross").select((F.lit(ranges) - reached).alias("rng"), F.lit(0).alias("copy"), "doc_id", "text", "tie", "key")
    # each range's first document also stands at the end of the range before it; the first of all, at the end of the last
    order = Window.orderBy("rng")
    heads = placed.groupBy("rng").agg(F.max("key").alias("head"))  # at most MAX_RANGES + 1 rows
    heads = heads.select(F.col("rng").alias("at"), "head", F.coalesce(F.lag("rng").over(order), F.max("rng").over(Window.orderBy(F.lit(0)))).alias("dest"))
    copies = placed.join(F.broadcast(heads), (F.col("rng") == F.col("at")) & F.col("key").eqNullSafe(F.col("head")))
    copies = copies.groupBy("dest", "doc_id", "tie").agg(F.first("text").alias("text")).select(F.col("dest").alias("rng"), F.lit(1).alias("copy"), "doc_id", "text", "tie")
    placed = placed.drop("key")
    w = Window.partitionBy("rng").orderBy("copy", F.col("doc_id").desc_nulls_last(), "tie")
    return placed.unionByName(copies).select(
        "rng", F.row_number().over(w).alias("nth"), "copy", "doc_id", "text", F.lead("text").over(w).alias("next_text")
    )


def member(d: int, k: int):
    """Whether a term is in the k-th subset of density 1/d; the densest ones leave out an eighth of the lexicon each."""
    if d == 1:
        return lambda t: F.pmod(F.shiftright(t, 57), F.lit(8)) != k
    return lambda t: F.pmod(F.shiftright(t, k * 2 + 1), F.lit(d)) == 0


def subset_hashes(found: Column, whole: Column) -> Column:
    """A hash of the sorted terms in each subset, null where there are none; without terms, the first is that of the whole text."""
    out = []
    for d, n in SUBSETS:
        for k in range(n):
            part = F.filter(found, member(d, k)) if out else found
            h = F.when(F.size(part) > 0, F.xxhash64(part))
            out.append(h if out else F.coalesce(h, whole))
    return F.array(*out)


def likeness(a: Column, b: Column) -> Column:
    """Equal hashes as a share of those that are set on either side."""
    pairs = F.zip_with(a, b, lambda x, y: F.when(x.isNull() & y.isNull(), None).otherwise(F.coalesce((x == y).cast("int"), F.lit(0))))
    told = F.filter(pairs, lambda x: x.isNotNull())
    return F.aggregate(told, F.lit(0), lambda s, x: s + x) / F.size(told)


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.coalesce(F.lower(F.hex(h)), F.lit("-"))), ".")


def fingerprint(docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> DataFrame:
    """Fingerprints of each text and of its edited text (its last half replaced by the next document's first half)."""
    docs = _common.columns(docs, doc_id="long", text="string").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lex = F.broadcast(lexicon(docs, min_share, max_share))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half))
    key = ["rng", "nth", "copy", "doc_id", "n_chars", "edited_sha256", "whole", "edited_whole"]
    both = beside(docs).select("rng", "nth", "copy", "doc_id", n.cast("long").alias("n_chars"), "text", F.when(F.col("copy") == 0, edited).alias("edited"))
    rows = both.select(
        *key[:5], F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.xxhash64("text").alias("whole"), F.xxhash64("edited").alias("edited_whole"),
        F.explode(F.array(F.struct(F.lit(0).alias("which"), terms(F.col("text")).alias("ws")), F.struct(F.lit(1).alias("which"), terms(F.coalesce("edited", F.lit(""))).alias("ws")))).alias("v"),
    )
    rows = rows.select(*key, F.col("v.which").alias("which"), F.explode(F.concat(F.transform("v.ws", lambda w: F.xxhash64(w)), F.array(F.lit(None).cast("long")))).alias("word"))
    hit = rows.join(lex.select("term"), rows["word"] == F.col("term"), "left").filter(F.col("word").isNull() | F.col("term").isNotNull())
    sets = hit.groupBy(*key).agg(
        F.sort_array(F.collect_set(F.when(F.col("which") == 0, F.col("term")))).alias("found"),
        F.sort_array(F.collect_set(F.when(F.col("which") == 1, F.col("term")))).alias("edited_found"),
    )
    prints = sets.select(*key[:6], subset_hashes(F.col("found"), F.col("whole")).alias("f"), subset_hashes(F.col("edited_found"), F.col("edited_whole")).alias("e"))
    w = Window.partitionBy("rng").orderBy("nth")
    return prints.withColumn("nf", F.lead("f").over(w)).filter("copy = 0").select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("f")).alias("fingerprint"), as_text(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("e")).alias("near_edited"), likeness(F.col("f"), F.col("nf")).alias("near_next"),
    )


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(_common.table(spark, sf_dir, "documents"))


QUERIES = {"op3_imatch": op3_imatch}
ORACLE: dict[str, str] = {}
