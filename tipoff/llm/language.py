"""Language identification by multilingual mixture inference.

Each language's byte n-gram distribution is learned from a bounded sample of training rows. A document is a mixture: each
word is drawn from one language with the document's proportions, which expectation-maximisation estimates from the words'
n-gram likelihoods. The language set grows from the likeliest language by the one that raises the likelihood most steeply,
as long as the likelihood less a penalty for each language in the set (BIC) rises; sets of any size can result.

Bounded sample: at most MAX_TRAIN rows outside the held-out fold, chosen by a hash of doc_id and text, whole texts. Inputs of
a prediction are the text's bytes alone.

Defined results: a null text, one without any letter, or one met by a model that learned nothing gives `und` with score
0; ties between languages go to the first in code point order; repeated rows give repeated results; texts of any length
are read whole; an empty table gives an empty result; extra columns are ignored. Letters A-Z are folded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm import _common, _text
from tipoff.llm.toxicity import LETTERS

MAX_TRAIN, TRAIN_TASKS, BUCKETS, GRAM = 4_000, 16, 1 << 16, 4
#: Add-one share of the smoothing, rounds of expectation-maximisation, share that a language joins with, tempering of a word's likelihood.
ALPHA, ROUNDS, JOIN, TEMPER = 0.5, 12, 0.2, 0.7
UNKNOWN = "und"

_FOLD = np.where(LETTERS, np.arange(256), 0x20).astype(np.uint8)
_FOLD[65:91] = np.arange(97, 123)


def grams(data: np.ndarray) -> np.ndarray:
    """The hashed n-gram that ends at each byte of the text, padded by spaces before and after (len + 1 values)."""
    x = np.full(len(data) + GRAM, 0x20, np.uint8)
    x[GRAM - 1 : -1] = _FOLD[data]
    h = np.zeros(len(data) + 1, np.uint32)
    for j in range(GRAM):
        h *= np.uint32(0x01000193)
        h += x[j : len(data) + 1 + j]
    return ((h * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


@_common.tidy
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        got: dict[str, np.ndarray] = {}
        for i, j, data, offs in _text.slices(batch, "text"):
            s, e, row = _text.word_bounds(data, offs, LETTERS)
            g = grams(data)
            inside = np.zeros(len(data) + 2, np.int64)
            np.add.at(inside, s, 1)
            np.add.at(inside, e + 1, -1)
            inside = np.cumsum(inside)[: len(data) + 1] > 0  # a word's bytes and the one after it
            at = np.minimum(np.searchsorted(offs, np.arange(len(data) + 1), "right") - 1, j - i - 1)
            for r in range(i, j):
                n = np.bincount(g[(at == r - i) & inside], minlength=BUCKETS) if j - i == 1 else None
                if n is None:
                    a, b = offs[r - i], offs[r - i + 1]
                    n = np.bincount(g[a:b][inside[a:b]], minlength=BUCKETS)
                got[langs[r]] = got[langs[r]] + n if langs[r] in got else n
        for lang, n in got.items():
            k = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k, pa.int64()), pa.array(n[k], pa.int64())], names=["lang", "g", "n"])


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray) -> None:
        self.langs = langs
        p = (counts + ALPHA * (counts.sum(0) + 1) / (counts.sum() + BUCKETS) * 1000 + 1e-3) if len(langs) else counts
        self.ll = np.log(p / p.sum(1, keepdims=True)).astype(np.float32) if len(langs) else p


def train(docs: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Learn from text and lang of at most max_train training rows."""
    spark = docs.sparkSession
    _common.ship(spark)
    ok = docs.filter("doc_id is not null and lang is not null and text is not null").filter(~_common.held_out())
    some = _common.bounded(ok.select("doc_id", "text", "lang"), max_train, "doc_id", "text", "lang")
    got = some.select("text", "lang").repartition(TRAIN_TASKS).mapInArrow(_count, "lang string, g long, n long").groupBy("lang", "g").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(got.lang))
    counts = np.zeros((len(langs), BUCKETS))
    counts[[langs.index(x) for x in got.lang], got.g.to_numpy(int)] = got.n.to_numpy(float)
    return Model(langs, counts)


def em(p: np.ndarray, pi: np.ndarray, row: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (documents x languages) and log-likelihoods; p: words x languages, sorted by document."""
    for k in range(rounds + 1):
        r = p * pi[row]
        total = r.sum(1, keepdims=True) + 1e-300
        if k == rounds:
            return pi, np.add.reduceat(np.log(total[:, 0]), starts)
        pi = np.add.reduceat(r / total, starts, axis=0) / sizes[:, None]
    return pi, np.zeros(len(pi))


def infer(data: np.ndarray, offs: np.ndarray, model: Model) -> np.ndarray:
    """Language proportions of each text (rows of zeros without words)."""
    n_docs, n_lang = len(offs) - 1, len(model.langs)
    out = np.zeros((n_docs, n_lang))
    s, e, row = _text.word_bounds(data, offs, LETTERS)
    if len(s) == 0 or n_lang == 0:
        return out
    g = grams(data)
    cut = np.stack([s, e + 1], 1).ravel()
    if cut[-1] >= len(g):
        cut = cut[:-1]
    # a word's end + 1 may be the next word's start: an equal index only yields a single value that is dropped
    u = np.stack([np.add.reduceat(ll[g], cut)[::2] for ll in model.ll], 1).astype(np.float64) * TEMPER
    p = np.exp(u - u.max(1, keepdims=True))
    docs, starts, sizes = np.unique(row, return_index=True, return_counts=True)
    every = np.add.reduceat(u, starts, axis=0)
    first = np.argmax(every, 1)
    pi = np.zeros((len(docs), n_lang))
    pi[np.arange(len(docs)), first] = 1.0
    rest = np.add.reduceat(u.max(1), starts)  # no mixture is likelier than each word's best language
    value = every[np.arange(len(docs)), first]
    live = np.flatnonzero(rest - value > penalty(sizes))
    while len(live):
        word = np.concatenate([np.arange(a, a + n) for a, n in zip(starts[live], sizes[live], strict=True)])
        n, q, pw = sizes[live], pi[live], p[word]
        begin = np.cumsum(n) - n
        at = np.repeat(np.arange(len(live)), n)
        # how fast the likelihood rises with each language's share
        slope = np.add.reduceat(pw / ((pw * q[at]).sum(1, keepdims=True) + 1e-300), begin, axis=0) - n[:, None]
        slope[q > 0] = -np.inf
        new = np.argmax(slope, 1)
        q = q * (1 - JOIN)
        q[np.arange(len(live)), new] = JOIN
        q, lik = em(pw, q, at, begin, n, ROUNDS)
        lik = lik + np.add.reduceat(u.max(1)[word], begin)
        better = (slope.max(1) > 0) & (lik - value[live] > penalty(n))
        pi[live[better]], value[live[better]] = q[better], lik[better]
        live = live[better]
        live = live[rest[live] - value[live] > penalty(sizes[live])]
    out[docs] = pi
    return out


def penalty(words: np.ndarray) -> np.ndarray:
    """What one more language in a document's set costs in log-likelihood."""
    return 0.5 * np.log(words + 1.0) + 1


@_common.tidy
def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lang, score = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows)
        for i, j, data, offs in _text.slices(b, "text"):
            pi = infer(data, offs, model)
            ascii_letters = np.r_[0, np.cumsum(LETTERS[data] & (data < 128))]
            plain = ascii_letters[offs[1:]] > ascii_letters[offs[:-1]]
            for r in np.flatnonzero(pi.sum(1) > 0):
                if plain[r] or any(c.isalpha() for c in b.column("text")[i + int(r)].as_py()):
                    k = int(np.argmax(pi[r]))
                    lang[i + r], score[i + r] = model.langs[k], min(1.0, pi[r, k])
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang), pa.array(score)], names=["doc_id", "lang_pred", "score"])


def identify(docs: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, the main language and its estimated share of the document's words."""
    docs = _common.columns(docs, doc_id="long", text="string", lang="string")
    model = train(docs, max_train)
    return docs.select("doc_id", "text").mapInArrow(lambda it: _predict(it, model), "doc_id long, lang_pred string, score double")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_common.table(spark, sf_dir, "documents")).select("doc_id", _common.held_out().alias("held_out"), "lang_pred", "score")


QUERIES = {"op5_language_id": op5_language_id}
ORACLE: dict[str, str] = {}
