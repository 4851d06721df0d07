"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from tipoff.llm import centroids, codes, contamination, fingerprints, language, mixing, neighbours, ngram_join, pieces, secrets, substrings, suffixes, toxicity

MODULES = (centroids, codes, contamination, fingerprints, language, mixing, neighbours, ngram_join, pieces, secrets, substrings, suffixes, toxicity)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.ORACLE.items()}
