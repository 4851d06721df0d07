"""Mixing, fingerprints, language and toxicity against definitions written out plainly."""

import itertools
import math
import re
import time

import brute
import numpy as np
import pytest
from conftest import prose

from tipoff.llm import fingerprints, language, mixing, toxicity


def test_mix_by_hand(spark, docs):
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    want = brute.mixed(rows, mixing.WEIGHTS, mixing.MAX_REPEATS, mixing.BLOCK, mixing.MIN_SHARDS, mixing.SEED)
    got = [(r.doc_id, r.source, r.size, r.target, r.taken) for r in mixing.mix_sources(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_offsets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COARSE", 3)
    rows = [(k % 2, k // 2, k * k) for k in range(40)]
    got = {(r.src, r.stretch): r.base for r in mixing.offsets(spark.createDataFrame(rows, "src int, stretch long, size long"), "src", "size").collect()}
    assert got == {(s, t): sum(v for a, b, v in rows if a == s and b < t) for s, t, _ in rows}


IDS = {"plain": lambda k: k, "wide": lambda k: (k * 0x9E3779B97F4A7C15 + 5) % (1 << 64) - (1 << 63), "far": lambda k: k if k else (1 << 63) - 1, "edges": lambda k: [-(1 << 63), (1 << 63) - 1, None][k] if k < 3 else k}


@pytest.mark.parametrize("kind", IDS)
@pytest.mark.parametrize("span", [2048, 4])
def test_imatch_by_hand(spark, fixture_rows, monkeypatch, kind, span):
    """Fingerprints and likenesses recomputed from the definition; ids of any width, one far id, null ids."""
    monkeypatch.setattr(fingerprints, "RANGE_DOCS", span)
    rows = [(IDS[kind](k), t if t is None or len(t) < 20_000 else t[:5_000]) for k, (_, t) in enumerate(fixture_rows)] + [(None, "no id"), (7 << 40, "one more text")]
    want = brute.imatch(rows, fingerprints.SUBSETS, 0.02, 0.5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    text = {brute.sha(t or ""): t or "" for _, t in rows}
    out = fingerprints.fingerprint(df, min_share=0.02, max_share=0.5).collect()
    assert len(out) == len(rows) and len(text) > 10
    left = dict(want)
    for r in out:
        mine = [k for k, v in left.items() if k[0] == r.doc_id and v[:4] == (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint)]
        assert mine, r
        v = left.pop(mine[0])
        assert abs(v[4] - r.near_edited) < 1e-12 and abs(v[5] - r.near_next) < 1e-12


def test_ranges_hold_equal_shares(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_DOCS", 100)
    ids = [*range(2000), 1 << 62, -(1 << 63)]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids] + [(None, f"n{k}") for k in range(1000)] + [(5, f"five {k}") for k in range(1000)], "doc_id long, text string")
    n = [r["count"] for r in fingerprints.beside(df).filter("copy = 0").groupBy("rng").count().collect()]
    assert max(n) < 400 and len(n) >= 20 and sum(n) == 4002


# --- language


def corpus(n_lang):
    r = np.random.default_rng(1)
    langs = [chr(97 + k) * 2 for k in range(n_lang)]
    vocab = {x: ["".join(r.choice(list("abcdefghijklmnopqrstuvwxyz"), int(r.integers(3, 9)))) for _ in range(60)] for x in langs}
    return langs, {x: lambda n, x=x: " ".join(r.choice(vocab[x], n)) for x in langs}


def test_four_languages_and_more(spark):
    """Equal parts of up to six languages: each is found with its share; sets have no greatest size."""
    langs, say = corpus(6)
    train = [(i, say[langs[i % 6]](80), langs[i % 6]) for i in range(240)]
    df = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = language.train(df)
    assert model.langs == langs
    for k in (1, 2, 4, 6):
        text = " ".join(say[x](120) for x in langs[:k]).encode()
        pi = language.infer(np.frombuffer(text, np.uint8), np.array([0, len(text)]), model)[0]
        assert (np.abs(pi[:k] - 1 / k) < 0.03).all() and pi[k:].sum() < 0.03, (k, pi)


def test_language_set_is_the_best_of_all(spark):
    """The greedy set's penalised likelihood against that of every subset, each fitted by many rounds."""
    langs, say = corpus(4)
    train = [(i, say[langs[i % 4]](60), langs[i % 4]) for i in range(160)]
    model = language.train(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    for parts in ((40, 0, 0, 0), (30, 10, 0, 0), (5, 5, 30, 0), (10, 10, 10, 10), (60, 2, 0, 1)):
        text = " ".join(say[x](n) for x, n in zip(langs, parts) if n).encode()
        data = np.frombuffer(text, np.uint8)
        s, e, _ = language._text.word_bounds(data, np.array([0, len(data)]), language.LETTERS)
        g = language.grams(data)
        u = np.array([[sum(float(ll[g[t]]) for t in range(a, b + 1)) for ll in model.ll] for a, b in zip(s, e)]) * language.TEMPER

        def value(pi):
            held = np.flatnonzero(pi > 0)
            w = u[:, held] + np.log(pi[held])
            top = w.max(1)
            return float((top + np.log(np.exp(w - top[:, None]).sum(1))).sum() - (len(held) - 1) * language.penalty(np.array([len(u)]))[0])

        best = -np.inf
        for k in range(1, 5):
            for held in itertools.combinations(range(4), k):
                pi = np.zeros(4)
                pi[list(held)] = 1 / k
                for _ in range(300):
                    w = np.exp(u - u.max(1, keepdims=True)) * pi
                    pi = (w / w.sum(1, keepdims=True)).mean(0)
                best = max(best, value(pi))
        got = language.infer(data, np.array([0, len(data)]), model)[0]
        assert value(got) > best - 0.5, (parts, got)


def test_training_rows_are_bounded(spark):
    """Rows that share a doc_id don't exceed the bound either."""
    rows = [(1, f"wort {k}", "de") for k in range(500)] + [(k, "word", "en") for k in range(500)]
    from tipoff.llm import _common

    got = _common.bounded(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 100, "doc_id", "text").collect()
    assert len(got) == 100 and len({r.text for r in got}) > 30


# --- toxicity


def test_segments_in_linear_time():
    """Hard orders of positive tokens: falling, rising and random totals, 200,000 of them."""
    r = np.random.default_rng(0)
    n = 200_000
    pos = np.arange(0, 3 * n, 3)
    for x in (np.linspace(2, 0.01, n), np.linspace(0.01, 2, n), r.random(n), np.full(n, 0.4), np.where(np.arange(n) % 2, 3.0, 0.1)):
        began = time.perf_counter()
        toxicity.maximal_segments(pos, x, 0.25)
        assert time.perf_counter() - began < 3


def test_calibration_recovers_the_law():
    """Best scores drawn from 1 - exp(-K n exp(-lambda x)): both parameters come back."""
    r = np.random.default_rng(2)
    n = r.integers(50, 2000, 20_000)
    m = np.maximum(np.log(0.02 * n / r.exponential(size=len(n))) / 0.7, 0)
    model = toxicity.Model(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), 0.1)
    model.calibrate(m, n)
    assert abs(model.lam - 0.7) < 0.03 and abs(model.k - 0.02) < 0.003


def test_scores_by_hand(spark):
    """Feature log-odds from counted strings, token scores, evidence and score recomputed for each document."""
    rows, labels = [], []
    for i in range(300):
        w = prose(3000 + i, 40)
        if i % 4 == 0:
            w[i % 30], w[(i + 7) % 30] = f"vilescum{'xyz'[i % 3]}", "Vilerat"
        rows.append((i, " ".join(w) if i else "", int(i % 4 == 0)))
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(d, d.select("doc_id", "toxic"))
    train = [(t, y) for i, t, y in rows if not brute_held(i)]
    n1, n0 = sum(y for _, y in train), sum(1 - y for _, y in train)
    tokens = lambda t: [x.lower() for x in re.findall(r"[A-Za-z]+", t)]
    feats = lambda w: [("w", w), *((p, w[:p]) for p in toxicity.PREFIXES if len(w) > p)]
    seen = {}
    for t, y in train:
        for f in {f for w in tokens(t) for f in feats(w)}:
            seen.setdefault(f, [0, 0])[y] += 1
    odds = {}
    for f, (y0, y1) in seen.items():
        if y0 + y1 < 2:
            continue
        share = toxicity.PRIOR * (y1 + y0 + 0.5) / (n1 + n0 + 1)
        a1, a0 = y1 + share + 0.5, y0 + share + 0.5
        o = math.log(a1 / (n1 + toxicity.PRIOR + 1 - a1)) - math.log(a0 / (n0 + toxicity.PRIOR + 1 - a0))
        z = o / math.sqrt(1 / a1 + 1 / a0)
        if z > toxicity.MIN_Z and o > toxicity.MIN_ODDS or z < -4:
            odds[f] = (abs(z), min(max(o, -1.0), toxicity.CLIP))
    assert len(model.keys) == len(odds) > 0

    def score(w):
        got = [odds[f] for f in feats(w) if f in odds]
        top = max((z for z, _ in got), default=0)
        return [o for z, o in got if z == top][0] if got else 0.0

    out = {r.doc_id: r for r in toxicity.score_toxicity(d, d.select("doc_id", "toxic")).collect()}
    for i, t, _ in rows:
        s = [score(w) for w in tokens(t)]
        live = [k for k, x in enumerate(s) if x]
        segs = toxicity.maximal_segments(np.array(live, np.int64), np.array([s[k] for k in live]), toxicity.DRIFT)
        x = sorted((model.lam * v - math.log(model.k * max(len(s), 1)) for _, _, v in segs), reverse=True)
        best = 0.0
        for r in range(1, len(x) + 1):
            total = sum(x[:r])
            if r == 1:
                p = 1 - math.exp(-math.exp(-x[0]))
            elif x[r - 1] > 0 and total > r:
                p = math.exp(-total) * total ** (r - 1) / (math.factorial(r) * math.factorial(r - 1)) * 2 ** (r - 1)
            else:
                break
            best = max(best, -math.log(p) if p < 1 else 0.0)
        assert abs(out[i].evidence - math.asinh(best / 2)) < 1e-6, (i, t)
        assert abs(out[i].score - 1 / (1 + math.exp(-(model.a * out[i].evidence + model.b)))) < 1e-9
    assert all((out[i].score >= toxicity.THRESHOLD) == bool(y) for i, t, y in rows if t)


def brute_held(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 4 == 2
