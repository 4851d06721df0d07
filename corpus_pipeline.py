"""The corpus pipeline: five stages over documents, each a training-data operator whose decisions take effect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm import _common, mixing, ngram_join, pieces, secrets, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; labels train it on this stage's documents.

    Null and empty texts are scored as having no evidence; rows that share a doc_id are judged each; an empty table stays empty.
    """
    return toxicity.drop_toxic(docs, _common.table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of documents linked by five-word shingles stays, once.

    Documents without words are linked with nothing and stay; rows without doc_id stay; an empty table stays empty.
    """
    return ngram_join.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to their kind in brackets; n_chars follows the text. All rows stay; null texts stay null."""
    return secrets.redact_secrets(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: words taken over its size, its fraction one more copy or none (see mixing.copies).

    Rows meet their copies by a hash of doc_id and text, so a row is repeated for its own words only and rows without doc_id don't meet
    in one task; rows without words go; equal rows are repeated alike.
    """
    times = mixing.copies(mixing.mix_sources(docs), docs.count()).filter("copies > 0")
    times = times.select(*(F.col(k).alias(f"_mixed_{k}") for k in times.columns))
    same = (mixing.row_tie() == times["_mixed_tie"]) & docs["doc_id"].eqNullSafe(times["_mixed_doc_id"]) & docs["source"].eqNullSafe(times["_mixed_source"])
    kept = docs.join(times.hint("merge"), same)
    return kept.withColumn("_mixed_copy", F.explode(F.sequence(F.lit(1), F.col("_mixed_copies")))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their sampled pieces; null and empty texts have none, repeated rows get one segmentation."""
    return pieces.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("source_mix", mix),
    ("piece_sampling", encode),
]

#: Learned scores and sampled draws can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written as Parquet in the shared folder and read again."""
    scratch = _common.Scratch(spark)
    docs = _common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        scratch.free()
    return STAGES[-1][1](spark, docs, sf_dir)
