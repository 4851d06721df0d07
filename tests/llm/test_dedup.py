"""Substring, suffix and n-gram operators against brute force."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tipoff.llm import _common, components, ngram_join, runs, substrings, suffixes


def got(df, *cols):
    return {r.doc_id: tuple(r[c] for c in cols) for r in df.collect() if r.doc_id is not None}


def test_substrings(docs, fixture_rows, monkeypatch):
    monkeypatch.setattr(runs, "CHUNK", 500)
    monkeypatch.setattr(runs, "BUCKET_BYTES", 50_000)
    want = brute.substring_dedup(fixture_rows)
    for batches in ((1.0,), (0.25, 0.75), (0.1,) * 10):  # the last one compacts runs
        out = substrings.remove_repeats(docs, batches)
        assert got(out, "n_words", "n_removed", "kept_sha256") == want
        assert out.count() == len(fixture_rows) + 2
        odd = out.filter("doc_id is null").collect()[0]
        assert odd.n_removed == 0 and odd.n_words == 200


def test_substring_collisions_are_caught(docs, fixture_rows, monkeypatch):
    """With hashes cut to a few bits under the first seed, the sum is not zero and another seed is taken."""
    real = substrings.Windows.of

    def weak(self, data, offs):
        row, at, h, v = real(self, data, offs)
        return row, at, (h & np.uint64(0x3FF) if self.seed == 0 else h), v

    monkeypatch.setattr(substrings.Windows, "of", weak)
    import pyspark.cloudpickle as cp

    import tipoff.llm.substrings as module

    cp.register_pickle_by_value(module)
    try:
        assert got(substrings.remove_repeats(docs), "n_words", "n_removed", "kept_sha256") == brute.substring_dedup(fixture_rows)
    finally:
        cp.unregister_pickle_by_value(module)


@pytest.mark.parametrize("most", [64, 1])
def test_suffixes(docs, fixture_rows, monkeypatch, most):
    """Both ways: groups that are sorted, and (most = 1) windows matched as rows."""
    monkeypatch.setattr(suffixes, "MAX_GROUP", most)
    rows = [*fixture_rows, (None, "no id here at all " * 40)]
    want = brute.byte_dedup(rows)
    want.pop(None)
    out = suffixes.remove_repeats(docs)
    assert got(out, "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert out.count() == len(fixture_rows) + 2


def test_suffix_order():
    words = [b"banana", b"band", b"ban", b"apple", b"banana", b""]
    s = suffixes.Suffixes(words)
    assert [words[k] for k in s.order()] == sorted(words)
    x = s.extensions()
    assert x[0, 1] == 3 and x[0, 4] == 6 and x[3, 0] == 0 and x[1, 2] == 3


def test_ngram_join(docs, fixture_rows, monkeypatch):
    monkeypatch.setattr(runs, "CHUNK", 500)
    monkeypatch.setattr(runs, "BUCKET_BYTES", 50_000)
    out = ngram_join.similar_components(docs)
    assert got(out, "n_shingles", "component_id") == brute.jaccard_components(fixture_rows)
    assert out.count() == len(fixture_rows) + 2


def test_one_of_each(docs, fixture_rows):
    want = brute.jaccard_components(fixture_rows)
    kept = ngram_join.one_of_each(docs)
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c} | {None}
    assert kept.columns == docs.columns


def test_components(spark):
    e = [(k, k + 1) for k in range(1, 40)] + [(100, 50), (100, 60), (60, 70), (7, 7)]
    out = components.components(spark.createDataFrame(e, "u long, v long"), _common.Scratch(spark))
    assert {r.node: r.component for r in out.collect()} == {**{k: 1 for k in range(1, 41)}, **{k: 50 for k in (50, 60, 70, 100)}}


def test_empty(no_docs):
    assert substrings.remove_repeats(no_docs).count() == 0
    assert suffixes.remove_repeats(no_docs).count() == 0
    assert ngram_join.similar_components(no_docs).count() == 0


def test_packed_runs():
    h = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    d = np.arange(1000) % 7
    back = [runs.entries(*x[1:]) for x in runs.pieces(h, d, d % 2, 8)]
    assert (np.concatenate([x[0] for x in back]) == h).all() and (np.concatenate([x[1] for x in back]) == d).all() and (np.concatenate([x[2] for x in back]) == d % 2).all()


@pytest.mark.parametrize("shared", [False, True])
def test_many_near_copies(spark, monkeypatch, shared):
    """A group of near copies around one text, some too far from it, their edits shared or not: components equal brute force."""
    monkeypatch.setattr(ngram_join, "NEAR_BLOCK", 7)
    monkeypatch.setattr(ngram_join, "FAR_BLOCK", 20)
    import random

    from conftest import prose

    base, rows = prose(9, 200), []
    calls = 200 if shared else 60
    for k in range(calls):
        r, w = random.Random(k), prose(9, 200)
        for p in r.sample(range(0, 200, 8) if shared else range(200), k % 12):
            w[p] = f"m{p}" if shared else f"n{k}_{p}"
        rows.append((k, " ".join(w)))
    rows.append((999, " ".join(base)))
    out = ngram_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(out, "n_shingles", "component_id") == brute.jaccard_components(rows)
    assert out.agg(F.count_distinct("component_id")).collect()[0][0] > 1


def test_block_links(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(ngram_join, "SLAB", 7)
    r = np.random.default_rng(0)

    def block(n, base):
        d = pd.DataFrame({"rep": np.arange(n) + base, "toks": [np.unique(r.choice(60, int(r.integers(48, 60)), replace=False)) for _ in range(n)], "component": np.arange(n) + base})
        return d.assign(n=[len(x) for x in d.toks], e=[len(x) for x in d.toks])

    u, v = block(20, 0), block(30, 100)
    want = {(a.rep, b.rep) for a in u.itertuples() for b in v.itertuples() if 100 * len(np.intersect1d(a.toks, b.toks)) >= 80 * len(np.union1d(a.toks, b.toks))}
    assert want and {tuple(x) for x in ngram_join._block_links(u, v).values.tolist()} == want


WIDE = {"wide": lambda k: (k * 0x9E3779B97F4A7C15 + 5) % (1 << 64) - (1 << 63), "far": lambda k: k if k != 30 else (1 << 63) - 1, "low": lambda k: k if k != 6 else -(1 << 63)}


@pytest.mark.parametrize("kind", WIDE)
def test_substrings_with_any_ids(spark, fixture_rows, monkeypatch, kind):
    monkeypatch.setattr(runs, "BUCKET_BYTES", 50_000)
    rows = [(WIDE[kind](i), t) for i, t in fixture_rows]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(substrings.remove_repeats(df), "n_words", "n_removed", "kept_sha256") == brute.substring_dedup(rows)


def test_suffixes_and_ngrams_with_any_ids(spark, fixture_rows):
    rows = [(WIDE["wide"](i), t) for i, t in fixture_rows]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(suffixes.remove_repeats(df), "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.byte_dedup(rows)
    assert got(ngram_join.similar_components(df), "n_shingles", "component_id") == brute.jaccard_components(rows)


def test_index_compacts_by_tiers(spark, docs, fixture_rows, monkeypatch):
    """Nine batches, the last indexed too: eight runs of tier 0 became two of tier 1 by two compactions; matches are those of brute force."""
    monkeypatch.setattr(runs, "BUCKET_BYTES", 50_000)
    index = substrings.FingerprintIndex(spark, 3)
    rows = sorted({(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.doc_id is not None})
    for k in range(9):
        index.add(spark.createDataFrame(rows[k * len(rows) // 9 : (k + 1) * len(rows) // 9], "doc_id long, text string"))
    assert index.compactions == 2 and sorted(t for t, _ in index.runs) == [0, 1, 1]
    held = [h for _, r in index.runs for x in r.collect() for h in runs.unpack_sorted(x.x).tolist()]
    windows = {tuple(w[k : k + 13]) for _, t in fixture_rows for w in [brute.WORD.findall(t or "")] for k in range(len(w) - 12)}
    assert len(held) == len(set(held)) == len(windows)


def test_the_query_compacts(spark, docs, monkeypatch):
    seen = []
    real = substrings.FingerprintIndex.compact
    monkeypatch.setattr(substrings.FingerprintIndex, "compact", lambda self: (real(self), seen.append(self.compactions)))
    substrings.remove_repeats(docs, texts=False)
    assert len(seen) == len(substrings.BATCHES) and seen[-1] == 1


@pytest.mark.parametrize("most", [0, 3])
def test_busy_shingles_in_blocks(spark, fixture_rows, monkeypatch, most):
    """Shingles of many holders are joined in blocks: the components stay those of brute force."""
    import random

    monkeypatch.setattr(ngram_join, "MANY_HOLDERS", most)
    from conftest import prose

    rows, common = [], prose(5, 100)
    for k in range(120):
        r = random.Random(k // 3)
        w = common + prose(200 + k // 6, 18) + [f"u{k}"]
        for p in r.sample(range(100), 2 + k % 4):
            w[p] = f"c{k // 3}"
        rows.append((k, " ".join(w)))
    rows += [(500 + i, t) for i, t in fixture_rows]
    out = ngram_join.similar_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(out, "n_shingles", "component_id") == brute.jaccard_components(rows)


def test_one_row_of_each(spark):
    """Rows that share a doc_id and a component leave one; those without words or doc_id stay."""
    from conftest import prose

    text = " ".join(prose(8, 50))
    rows = [(5, text, "x"), (5, text, "x"), (5, text + " tail", "y"), (7, text, "z"), (9, None, "n"), (9, "", "n"), (None, text, "i"), (None, text, "i"), (11, "short", "s")]
    kept = ngram_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted((str(r.doc_id), r.source) for r in kept if r.doc_id != 5) == [("11", "s"), ("9", "n"), ("9", "n"), ("None", "i"), ("None", "i")]
    assert sum(r.doc_id == 5 for r in kept) == 1


@pytest.mark.parametrize("n_bytes", [395, 399, 400, 401, 450])
def test_passages_about_the_length(spark, n_bytes):
    """Planted passages of 395 to 450 bytes in two documents, whatever their number of words: those under 400 bytes stay."""
    from conftest import prose

    passage = " ".join(prose(77, 90))[:n_bytes]
    rows = [(k, " ".join(prose(300 + k, 60)) + f"<{k} " + passage + f" {k}>" + " ".join(prose(400 + k, 60))) for k in range(2)] + [(9, " ".join(prose(500, 90)))]
    out = got(suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert out == brute.byte_dedup(rows)
    assert [out[k][1] for k in (0, 1, 9)] == ([n_bytes + 2] * 2 if n_bytes + 2 >= 400 else [0, 0]) + [0]


@pytest.mark.parametrize("most", [64, 1])
def test_short_repeats_are_counted(spark, fixture_rows, monkeypatch, most):
    """Passages of over 50 words and under 400 bytes stay, and n_repeated tells of them; both ways of matching."""
    from conftest import prose

    monkeypatch.setattr(suffixes, "MAX_GROUP", most)
    own = [(2000 + k, " ".join(prose(700 + k, 80))) for k in range(12)]
    rows = own[8:] + [*fixture_rows]
    for k in range(4):
        passage = " ".join(w[:5] for w in prose(800 + k, 52 + 2 * k))
        assert suffixes.SHORT <= len(passage.encode()) < suffixes.LENGTH
        rows += [(i, f"{t} <{i} {passage} {i}> {t[::-1]}") for i, t in own[2 * k : 2 * k + 2]]
    out = suffixes.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert got(out, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.byte_dedup(rows)
    repeated = {i: v[0] for i, v in got(out, "n_repeated").items()}
    assert repeated == {i: v[1] for i, v in brute.byte_dedup(rows, suffixes.SHORT).items()}
    assert all(repeated[i] for i, _ in own[:8]) and not any(repeated[i] for i, _ in own[8:])
