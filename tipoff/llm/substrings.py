"""Substring deduplication with a log-structured fingerprint index.

Documents come in batches of ascending doc_id. A batch's window hashes are sorted into runs and merge-joined, bucket by
bucket, with the index: sorted immutable runs of the windows of earlier batches. Windows found there, or in a smaller
doc_id of the batch, are repeated. The windows that are new become a run of the index; FAN_OUT runs of one tier are compacted
into one of the next tier, so that an entry is rewritten a logarithmic number of times.

Verification: each match contributes the difference of a second, independent 64-bit digest of the two windows' words (for
matches inside a chunk the digests are compared at once). The differences of all matches must sum to zero; if not, some hashes
collided and the job is repeated with other hash functions.

Defined results: null and empty texts have no words; a document without doc_id takes no part and keeps its words; rows that
share a doc_id don't repeat each other; any 64-bit ids do; texts shorter than a window lose nothing, texts of any length are
read whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm import _common, _text, runs
from tipoff.llm._text import MASK, U64

WINDOW, FAN_OUT = 13, 4
#: Share of the documents, by ascending doc_id, in each batch of the query: a history in four batches, and those that arrive after it.
BATCHES = (0.125, 0.125, 0.125, 0.125, 0.5)
MULT, CHECK_MULT, BASE = 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F


class Windows:
    """Hashes and check digests of the windows of texts."""

    def __init__(self, seed: int, size: int = WINDOW) -> None:
        self.seed, self.size = seed, size
        self.tables = _text.byte_table(100 + 2 * seed), _text.byte_table(101 + 2 * seed)

    def of(self, data: np.ndarray, offs: np.ndarray):
        """Row of each word, and (first word, hash, check) of each window."""
        s, e, row = _text.word_bounds(data, offs)
        h = _text.ngrams(_text.word_hashes(data, s, e, self.tables[0], BASE), self.size, MULT, self.seed)
        at = np.flatnonzero(row[self.size - 1 :] == row[: len(h)]) if len(h) else np.zeros(0, np.int64)
        v = _text.ngrams(_text.word_hashes(data, s, e, self.tables[1], BASE ^ 0x5A5A5A5A00), self.size, CHECK_MULT, self.seed + 7)
        return row, at, h[at], v[at] if len(v) else v


def _chunk_rows(h, v, doc, pos, buckets: int):
    """Packed pieces of one chunk, and spans of windows that repeat inside it."""
    o = np.argsort(h, kind="stable")
    h, v, doc, pos = h[o], v[o], doc[o], pos[o]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    size = np.diff(np.r_[first, len(h)])
    least = np.repeat(np.minimum.reduceat(doc, first), size)
    same = np.repeat(np.minimum.reduceat(v, first) == np.maximum.reduceat(v, first), size)
    again = (doc > least) & same
    keep = np.flatnonzero(~again)
    one = np.r_[True, (h[keep][1:] != h[keep][:-1]) | ~same[keep][1:]]  # one entry for each hash, all of a hash that collides
    keep = keep[one]
    for b, ids, hashes, who in runs.pieces(h[keep], doc[keep], np.zeros(len(keep), np.int64), buckets):
        yield b, 0, ids, hashes, who
    d, p = doc[again], pos[again]
    if len(d):
        o = np.lexsort((p, d))
        d, p = d[o], p[o]
        new = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (p[1:] > p[:-1] + 1)])
        last = np.r_[new[1:], len(d)] - 1
        for b in np.unique(d[new] % buckets):
            k = d[new] % buckets == b
            yield int(b), 1, runs.pack(d[new][k]), runs.pack(p[new][k].astype(np.int32)), runs.pack((p[last][k] + 1).astype(np.int32))


@_common.tidy
def _map(batches: Iterator[pa.RecordBatch], buckets: int, seed: int) -> Iterator[pa.RecordBatch]:
    win, held, n = Windows(seed), [], 0

    def flush():
        rows = list(_chunk_rows(*(np.concatenate(x) for x in zip(*held, strict=True)), buckets))
        held.clear()
        cols = list(zip(*rows, strict=True)) or [(), (), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "kind", "docs", "hashes", "who"])

    for b in batches:
        ids = b.column("doc_id").to_numpy(zero_copy_only=False)
        for i, _, data, offs in _text.slices(b, "text"):
            row, at, h, v = win.of(data, offs)
            if len(at):
                begin = _text.row_slices(row, len(offs) - 1)
                held.append((h, v, ids[i + row[at]], at - begin[row[at]]))
                n += len(at)
            if n >= runs.CHUNK:
                yield flush()
                n = 0
    if held:
        yield flush()


def _by_group(kind: int, groups: int, doc, x, y) -> list[tuple]:
    """Rows (bucket, kind, group, documents, x, y) of packed arrays, one for each group of documents."""
    g = np.mod(doc, groups)
    o = np.lexsort((doc, g))
    g, doc, x, y = g[o], doc[o], x[o], y[o]
    lim = np.r_[np.flatnonzero(np.r_[True, g[1:] != g[:-1]]), len(g)]
    return [(-1, kind, int(g[a]), runs.pack(np.diff(doc[a:b], prepend=0)), runs.pack(x[a:b]), runs.pack(y[a:b])) for a, b in zip(lim[:-1], lim[1:], strict=True)]


@_common.tidied
def _merge(key: tuple, index: pd.DataFrame, new: pd.DataFrame, groups: int, keep_run: bool) -> pd.DataFrame:
    """Merge-join one bucket of a batch with the index.

    Out, packed by group of documents: kind 0: documents, hashes, weights: 1 for a repeated window, -k for one that k others
    repeat; kind 1: documents, first words, ends of spans settled in chunks; kind 2: the bucket's new run (hashes, documents).
    """
    part, local = new[new.kind == 0], new[new.kind == 1]
    out = []
    if len(part):
        h, d, _ = (np.concatenate(x) for x in zip(*[runs.entries(*x) for x in zip(part.docs, part.hashes, part.who, strict=True)], strict=True))
        o = np.lexsort((d, h))
        h, d = h[o], d[o]
        first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        one, source, fresh = h[first], d[first].copy(), np.ones(len(first), bool)
        for x, y in zip(index.x, index.y, strict=True):  # a run after the other, both sides sorted
            old_h, old_d = runs.unpack_sorted(x), runs.unpack(y, np.int64)
            at = np.minimum(np.searchsorted(old_h, one), len(old_h) - 1)
            same = np.flatnonzero(old_h[at] == one)
            source[same] = np.minimum(source[same], old_d[at[same]])
            fresh[same] = False
        hit = d > np.repeat(source, np.diff(np.r_[first, len(h)]))
        k = np.add.reduceat(hit.astype(np.int64), first)
        used = k > 0
        if used.any():
            out += _by_group(0, groups, np.r_[d[hit], source[used]], np.r_[h[hit], one[used]], np.r_[np.ones(int(hit.sum()), np.int32), -k[used].astype(np.int32)])
        if keep_run and fresh.any():
            out.append((key[0], 2, -1, b"", runs.pack_sorted(one[fresh]), runs.pack(d[first][fresh])))
    if len(local):
        out += _by_group(1, groups, *(np.concatenate([runs.unpack(v, t) for v in local[c]]) for c, t in (("docs", np.int64), ("hashes", np.int32), ("who", np.int32))))
    return pd.DataFrame(out, columns=["bucket", "kind", "g", "docs", "x", "y"])


@_common.tidied
def _compact(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """One run of a bucket from several: the smallest document of each hash stays."""
    h = np.concatenate([runs.unpack_sorted(x) for x in pdf.x])
    d = np.concatenate([runs.unpack(y, np.int64) for y in pdf.y])
    o = np.lexsort((d, h))
    h, d = h[o], d[o]
    one = np.r_[True, h[1:] != h[:-1]]
    return pd.DataFrame({"bucket": [key[0]], "x": [runs.pack_sorted(h[one])], "y": [runs.pack(d[one])]})


FOUND, RUN = "bucket int, kind int, g long, docs binary, x binary, y binary", "bucket int, x binary, y binary"


class FingerprintIndex:
    """The log-structured index: add batches in ascending order of doc_id."""

    def __init__(self, spark: SparkSession, buckets: int, seed: int = 0, scratch: _common.Scratch | None = None) -> None:
        self.spark, self.buckets, self.groups, self.seed = spark, buckets, runs.groups_of(buckets), seed
        self.scratch = scratch or _common.Scratch(spark)
        self.runs: list[tuple[int, DataFrame]] = []  # with their tiers
        self.folders: list[tuple[DataFrame, str]] = []  # where each run is
        self.compactions = 0

    def add(self, docs: DataFrame, keep_run: bool = True) -> DataFrame:
        """Matches of a batch (see _merge); with keep_run, the batch joins the index."""
        buckets, groups, seed = self.buckets, self.groups, self.seed
        new = docs.filter("doc_id is not null").mapInArrow(lambda it: _map(it, buckets, seed), runs.PIECE)
        index = self.spark.createDataFrame([], RUN)
        for _, r in self.runs:
            index = index.unionByName(r)
        got = index.groupBy("bucket").cogroup(new.groupBy("bucket")).applyInPandas(lambda k, a, b: _merge(k, a, b, groups, keep_run), FOUND)
        got = self.scratch.keep(got, "matches", by="kind")
        self.scratch.free()
        if keep_run:
            self.runs.append((0, got.filter("kind = 2").select("bucket", "x", "y")))
            self.folders.append((got, "/kind=2"))
            self.compact()
        return got.filter("kind < 2").select("kind", "g", "docs", "x", "y")

    def compact(self) -> None:
        """Merge the runs of a tier into one of the next as long as a tier has FAN_OUT runs."""
        tier = 0
        while any(t >= tier for t, _ in self.runs):
            same = [k for k, (t, _) in enumerate(self.runs) if t == tier]
            if len(same) >= FAN_OUT:
                every = self.runs[same[0]][1]
                for k in same[1:]:
                    every = every.unionByName(self.runs[k][1])
                merged = self.scratch.keep(every.groupBy("bucket").applyInPandas(lambda k, p: _compact(k, p), RUN), "run")
                for k in same:  # the runs that it replaces go
                    self.scratch.drop(self.folders[k][0], folder=self.folders[k][1])
                rest = [k for k in range(len(self.runs)) if k not in same]
                self.folders = [self.folders[k] for k in rest] + [(merged, "")]
                self.runs = [self.runs[k] for k in rest] + [(tier + 1, merged)]
                self.compactions += 1
            tier += 1

    def close(self) -> None:
        """Delete the runs; what add() returned stays."""
        for table, folder in self.folders:
            self.scratch.drop(table, folder=folder)
        self.runs, self.folders = [], []


def _removed(docs: list[tuple[int, bytes]], found: pd.DataFrame, seed: int) -> tuple[dict[int, np.ndarray], int]:
    """Mask of removed words by place in docs, for documents with matches; and the sum that verifies the matches."""
    win = Windows(seed)
    cols = {k: [np.concatenate(x) for x in zip(*[(np.cumsum(runs.unpack(d, np.int64)), runs.unpack(x, t), runs.unpack(y, np.int32)) for d, x, y in zip(part.docs, part.x, part.y, strict=True)], strict=True)]
            for k, t in ((0, U64), (1, np.int32)) if len(part := found[found.kind == k])}
    matched = np.unique(np.concatenate([c[0] for c in cols.values()])) if cols else np.zeros(0, np.int64)
    todo = [k for k, (i, _) in enumerate(docs) if i is not None and len(matched) and matched[min(np.searchsorted(matched, i), len(matched) - 1)] == i]
    out: dict[int, np.ndarray] = {}
    balance, once = 0, set()
    while todo:  # about 4 MB at a time
        part, size = [], 0
        while todo and (not part or size + len(docs[todo[0]][1]) <= 4 << 20):
            part.append(todo.pop(0))
            size += len(docs[part[-1]][1])
        offs = np.r_[0, np.cumsum([len(docs[k][1]) for k in part])]
        data = np.frombuffer(b"".join(docs[k][1] for k in part), np.uint8)
        row, at, h, v = win.of(data, offs)
        ids = np.array([docs[k][0] for k in part], np.int64)
        word = _text.row_slices(row, len(part))
        gone = np.zeros(len(row) + 1, np.int64)
        order = np.argsort(ids, kind="stable")
        for kind, (d, x, y) in cols.items():
            lo, hi = np.searchsorted(ids[order], d), np.searchsorted(ids[order], d, "right")
            n = hi - lo  # rows that share a doc_id all lose the words; the first of them is verified
            m = np.repeat(np.arange(len(d)), n)
            r = order[np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]
            if kind == 1:
                end = word[r + 1] - word[r]
                np.add.at(gone, word[r] + np.minimum(x[m], end), 1)
                np.add.at(gone, word[r] + np.minimum(y[m] + WINDOW - 1, end), -1)
                continue
            mine = _text.mix(h ^ (row[at].astype(U64) * U64(0x9E3779B97F4A7C15)), 3)
            want = _text.mix(x[m] ^ (r.astype(U64) * U64(0x9E3779B97F4A7C15)), 3)
            o = np.argsort(mine)
            a, b = np.searchsorted(mine[o], want), np.searchsorted(mine[o], want, "right")
            new = np.array([int(i) not in once for i in ids], bool)
            seen = (b > a) & new[r] & (r == order[lo[m]])
            balance += int((v[o[a[seen]]] * y[m][seen].astype(np.int64).view(U64)).sum(dtype=U64))
            k = np.where(y[m] > 0, b - a, 0)
            spots = at[o[np.repeat(a, k) + np.arange(int(k.sum())) - np.repeat(np.cumsum(k) - k, k)]]
            np.add.at(gone, spots, 1)
            np.add.at(gone, spots + WINDOW, -1)
        once.update(ids.tolist())
        mask = np.cumsum(gone)[:-1] > 0
        for j, k in enumerate(part):
            out[k] = mask[word[j] : word[j + 1]]
    return out, balance


@_common.tidied
def _finish(docs: pd.DataFrame, found: pd.DataFrame, seed: int, texts: bool) -> pd.DataFrame:
    """Removed words and the kept words' digest of a group of documents; its first row has the verification sum."""
    rows = [(None if pd.isna(i) else int(i), (t or "").encode()) for i, t in zip(docs.doc_id, docs.text, strict=True)]
    gone, balance = _removed(rows, found, seed)
    out = []
    for k, (i, raw) in enumerate(rows):
        words = raw.split()
        left = [words[j] for j in np.flatnonzero(~gone[k]).tolist()] if k in gone and gone[k].any() else words
        kept = b" ".join(left)
        out.append((i, len(words), len(words) - len(left), hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None, 0))
    out = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "balance"])
    balance &= MASK
    if len(out):
        out["balance"] = np.r_[np.array([balance - (1 << 64) if balance >> 63 else balance], np.int64), np.zeros(len(out) - 1, np.int64)]
    return out.astype({"doc_id": "Int64"})


def _finisher(seed: int, texts: bool):
    return lambda docs, found: _finish(docs, found, seed, texts)


APPLIED = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, balance long"


def remove_repeats(docs: DataFrame, batches: tuple[float, ...] = BATCHES, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and (texts) kept: each text without the words of repeated windows."""
    spark = docs.sparkSession
    _common.ship(spark)
    docs = _common.columns(docs, doc_id="long", text="string")
    buckets = runs.n_buckets(docs)
    ends = (np.cumsum(batches) / sum(batches))[:-1].tolist()
    cuts = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, ends)), 10_000)).collect()[0][0] if ends else []
    cuts = [None, *(cuts or [0] * len(ends)), None]  # batch k: after cut k up to cut k + 1
    for seed in range(8):
        scratch = _common.Scratch(spark)
        index, found = FingerprintIndex(spark, buckets, seed, scratch), None
        for k in range(len(batches)):
            after = F.lit(True) if cuts[k] is None else F.col("doc_id") > cuts[k]
            upto = F.lit(True) if cuts[k + 1] is None else F.col("doc_id") <= cuts[k + 1]
            got = index.add(docs.filter(after & upto))
            found = got if found is None else found.unionByName(got)
        index.close()  # the query needs its matches only
        # a null id has a group of its own by hash of the text, so such rows don't meet in one task
        g = F.coalesce(F.pmod("doc_id", F.lit(index.groups)), F.pmod(F.xxhash64("text"), F.lit(index.groups)))
        done = docs.withColumn("g", g).groupBy("g").cogroup(found.groupBy("g")).applyInPandas(_finisher(seed, texts), APPLIED)
        done = scratch.keep(done if texts else done.drop("kept"), "done")
        scratch.free()
        total = done.agg(F.sum(F.shiftright("balance", 32)), F.sum(F.col("balance").bitwiseAND(0xFFFFFFFF))).collect()[0]
        if ((total[0] or 0) * (1 << 32) + (total[1] or 0)) % (1 << 64) == 0:
            scratch.close(done)
            return done.drop("balance")
        scratch.close()
    raise RuntimeError("window hashes collided under every seed")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_common.table(spark, sf_dir, "documents"), texts=False)


QUERIES = {"op7_substring_dedup": op7_substring_dedup}
ORACLE: dict[str, str] = {}
