"""Suffix-array deduplication of byte strings that occur twice.

A byte goes if a string of LENGTH bytes that covers it also starts anywhere else, in any document or its own. Shorter repeats stay
and are counted: n_repeated is the number of bytes that such strings of SHORT bytes cover (those that go included).

1. Every window of SHORT and of LENGTH bytes is assigned the smallest hashed GRAM-byte string in it (its anchor). Equal windows have equal
   anchors at equal offsets, so only windows of one anchor are compared. A stretch is the bytes of all windows of a place with one anchor; anchors
   that occur once are dropped, stretches with equal bytes (128-bit digests) are settled at once, whatever their number.
2. Among the distinct stretches of an anchor, the suffixes at the anchor (and the reversed prefixes before it) are sorted
   by a merge sort whose comparisons take logarithmic time: prefix polynomial hashes and binary search give the longest common
   extension, which the bytes then verify. Common extensions of any two are range minima over neighbours.
3. Anchors with more than MAX_GROUP distinct stretches (a line that many documents share) are not gathered: their windows are
   matched by digest as rows, after a test on the bytes that windows of neighbouring offsets share.

Defined results: null texts are empty texts; texts shorter than LENGTH lose nothing; documents without doc_id and rows that
share one are separate documents; repeated rows repeat each other's strings; texts of any length are taken whole; an empty
table gives an empty result; extra columns are ignored. Texts are UTF-8 bytes; matches never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm import _common, _text
from tipoff.llm._text import MASK, U64

LENGTH, SHORT, GRAM, MAX_GROUP, OFFSETS = 400, 256, 32, 64, 64
TABLE, BASE = _text.byte_table(40), 0xC2B2AE3D27D4EB4F
INVERSE = pow(BASE, -1, 1 << 64)
STRETCH = "k1 long, k2 long, anchor long, e1 long, e2 long, lo int, hi int, x int"


def digest(data: memoryview) -> tuple[int, int]:
    """A 128-bit digest as two signed longs."""
    d = xxhash.xxh3_128_digest(data)
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Polynomial hash of each string of `size` bytes."""
    n = len(data) - size + 1
    s = np.r_[U64(0), np.cumsum(TABLE[data] * _text.powers(BASE, len(data)), dtype=U64)]
    return _text.mix((s[size:] - s[:n]) * _text.powers(INVERSE, n))


def window_minima(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values."""
    n = len(x) - w + 1
    pad = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, U64)
    pad[: len(x)] = x
    blocks = pad.reshape(-1, w)
    left = np.minimum.accumulate(blocks, 1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[w - 1 : w - 1 + n])


def ranges(key: np.ndarray, row: np.ndarray, offs: np.ndarray, size: int):
    """Row, anchor place, first byte and end of each run of windows of `size` bytes with one anchor; places ascend."""
    n = max(0, len(row) - size + 1)
    ok = np.flatnonzero(np.arange(n) + size <= offs[row[:n] + 1])
    if not len(ok):
        return (np.zeros(0, np.int64),) * 4
    place, row = (window_minima(key, size - GRAM + 1)[ok] & U64((1 << 30) - 1)).astype(np.int64), row[ok]
    new = np.r_[True, (place[1:] != place[:-1]) | (row[1:] != row[:-1]) | (ok[1:] != ok[:-1] + 1)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(ok)] - 1
    return row[first], place[first], ok[first], ok[last] + size


def stretches(data: np.ndarray, offs: np.ndarray):
    """Row, anchor, first byte, end and anchor place of each stretch (all relative to the slice)."""
    if len(data) < SHORT:
        z = np.zeros(0, np.int64)
        return z, np.zeros(0, U64), z, z, z
    g = gram_hashes(data)
    key = (g >> U64(30) << U64(30)) | np.arange(len(g), dtype=U64)  # ties: the leftmost
    rows = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    row, place, lo, hi = ranges(key, rows, offs, SHORT)
    _, wide, a, z = ranges(key, rows, offs, LENGTH)
    at = np.searchsorted(place, wide)  # an anchor of LENGTH bytes is one of SHORT bytes too, and its windows reach further
    lo[at], hi[at] = a, z
    return row, g[place], lo, hi, place


@_common.tidy
def _map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        k1, k2 = (b.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
        for i, _, data, offs in _text.slices(b, "text"):
            row, anchor, lo, hi, place = stretches(data, offs)
            view = memoryview(np.ascontiguousarray(data))
            d = np.array([digest(view[a:z]) for a, z in zip(lo.tolist(), hi.tolist(), strict=True)], np.int64).reshape(-1, 2)
            at = offs[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[i + row]), pa.array(k2[i + row]), pa.array(anchor.view(np.int64)), pa.array(d[:, 0]), pa.array(d[:, 1]),
                 *(pa.array(v.astype(np.int32)) for v in (lo - at, hi - at, place - lo))],
                names=["k1", "k2", "anchor", "e1", "e2", "lo", "hi", "x"],
            )


@_common.tidy
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted stretches of each text."""
    for b in batches:
        cols: list[list] = [[] for _ in range(7)]
        for text, want in zip(b.column("text"), b.column("want"), strict=True):
            raw = (text.as_py() or "").encode()
            for w in want.as_py():
                for c, v in zip(cols, (w["anchor"], w["e1"], w["e2"], w["n"], w["m"], w["x"], raw[w["lo"] : w["hi"]]), strict=True):
                    c.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["anchor", "e1", "e2", "n", "m", "x", "piece"])


PIECE = "anchor long, e1 long, e2 long, n long, m long, x int, piece binary"


class Suffixes:
    """Strings with prefix polynomial hashes: longest common extensions by binary search, verified on the bytes."""

    def __init__(self, strings: list[bytes]) -> None:
        self.strings = strings
        data = np.frombuffer(b"".join(strings), np.uint8)
        s = np.r_[U64(0), np.cumsum(TABLE[data] * _text.powers(BASE, len(data)), dtype=U64)]
        self.s, self.first = s.tolist(), np.r_[0, np.cumsum([len(x) for x in strings])].tolist()
        inv = _text.powers(INVERSE, len(data) + 1)
        self.inv = [int(inv[a]) for a in self.first[:-1]]

    def common(self, i: int, j: int) -> int:
        a, b, s = self.first[i], self.first[j], self.s
        ia, ib, sa, sb = self.inv[i], self.inv[j], s[a], s[b]
        lo, hi = 0, min(len(self.strings[i]), len(self.strings[j]))
        x, y = self.strings[i], self.strings[j]
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if ((s[a + mid] - sa) * ia) & MASK == ((s[b + mid] - sb) * ib) & MASK:
                lo = mid
            else:
                hi = mid - 1
        if x[:lo] != y[:lo]:  # a collision: compare the bytes
            lo = next(k for k in range(lo) if x[k] != y[k])
        return lo

    def order(self) -> list[int]:
        """Merge sort (Python's is one) of the strings, compared through their longest common extension."""

        def compare(i: int, j: int) -> int:
            k = self.common(i, j)
            x, y = self.strings[i], self.strings[j]
            if k == len(x) or k == len(y):
                return len(x) - len(y)
            return x[k] - y[k]

        return sorted(range(len(self.strings)), key=cmp_to_key(compare))

    def extensions(self) -> np.ndarray:
        """Longest common extensions of all pairs, as range minima over neighbours in sorted order."""
        o, m = self.order(), len(self.strings)
        near = np.array([self.common(a, b) for a, b in zip(o[:-1], o[1:], strict=True)], np.int64)
        out = np.zeros((m, m), np.int64)
        for k in range(m - 1):
            out[o[k], o[k + 1 :]] = np.minimum.accumulate(near[k:])
        return np.maximum(out, out.T)


def group_matches(group: list[tuple]) -> list[tuple]:
    """(e1, e2, starts, ends, near, far): repeated bytes of each stretch that is alone, by strings of LENGTH and of SHORT bytes; group: (e1, e2, n, x, bytes), distinct."""
    right = Suffixes([p[x:] for *_, x, p in group]).extensions()
    left = Suffixes([p[:x][::-1] for *_, x, p in group]).extensions()
    out = []
    for i, (e1, e2, n, x, _) in enumerate(group):
        if n > 1:
            continue
        other = np.arange(len(group)) != i
        lo, hi = x - left[i][other], x + right[i][other]  # the longest string around the anchor that each other one has too
        spans = [v.tolist() for size in (LENGTH, SHORT) for v in _text.merge_spans(lo[hi - lo >= size], hi[hi - lo >= size])]
        if spans[2]:
            out.append((e1, e2, *spans))
    return out


@_common.tidy
def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of one anchor follow each other; each is at most MAX_GROUP stretches."""
    held, now, out = [], None, []
    for b in batches:
        for a, e1, e2, n, x, p in zip(*(b.column(c).to_pylist() for c in ("anchor", "e1", "e2", "n", "x", "piece")), strict=True):
            if a != now:
                if len(held) > 1:
                    out += group_matches(held)
                held, now = [], a
            if not any(h[:2] == (e1, e2) for h in held):
                held.append((e1, e2, n, x, p))
        yield _matches(out)
        out = []
    yield _matches(group_matches(held) if len(held) > 1 else [])


def _matches(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 6
    kinds = (pa.int64(), pa.int64(), *(pa.list_(pa.int32()),) * 4)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["e1", "e2", "starts", "ends", "near", "far"])


MATCHES = "e1 long, e2 long, starts array<int>, ends array<int>, near array<int>, far array<int>"


@_common.tidy
def _windows(batches: Iterator[pa.RecordBatch], cores: bool) -> Iterator[pa.RecordBatch]:
    """Digests of the cores of stretches (t: group of offsets before the anchor), or of the windows in the groups listed in `ts`."""
    for b in batches:
        rows = []
        ts = b.column("ts").to_pylist() if not cores else [()] * b.num_rows
        for e1, e2, x, p, asked in zip(*(b.column(c).to_pylist() for c in ("e1", "e2", "x", "piece")), ts, strict=True):
            view, asked = memoryview(p), {(w["size"], w["t"]) for w in asked}
            for size in (LENGTH, SHORT) if len(p) >= LENGTH else (SHORT,):
                least, most = max(x - (len(p) - size), 0), min(x, size - GRAM)  # windows that hold the anchor
                for t in range(least // OFFSETS, most // OFFSETS + 1):
                    near, far = max(t * OFFSETS, least), min(t * OFFSETS + OFFSETS - 1, most)
                    if cores:
                        # bytes that every window of the group of offsets has
                        a, z = x - t * OFFSETS, x - t * OFFSETS - OFFSETS + 1 + size
                        rows.append((*digest(view[a : min(z, len(p))]), e1, e2, t, size, z <= len(p)))
                    elif (size, t) in asked:
                        rows += [(*digest(view[x - o : x - o + size]), e1, e2, x - o, size, True) for o in range(near, far + 1)]
        cols = list(zip(*rows, strict=True)) or [()] * 7
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["w1", "w2", "e1", "e2", "t", "size", "whole"])


WINDOW = "w1 long, w2 long, e1 long, e2 long, t int, size int, whole boolean"


@_common.tidy
def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "n_repeated": [], "kept": []}
        for text, found in zip(b.column("text"), b.column("found").to_pylist(), strict=True):
            raw = (text.as_py() or "").encode()
            kept, spans, repeated = raw, 0, 0
            if found:
                (s, e), (near, far) = (
                    _text.merge_spans(*(np.concatenate([np.asarray(f[c], np.int64) + f["lo"] for f in found]) for c in pair)) for pair in (("starts", "ends"), ("near", "far"))
                )
                spans, repeated = len(s), int((far - near).sum())
                cuts = [0, *np.stack([s, e], 1).ravel().tolist(), len(raw)]
                kept = b"".join(raw[a:z] for a, z in zip(cuts[::2], cuts[1::2], strict=True))
            for k, v in zip(out, (len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest(), repeated, kept), strict=True):
                out[k].append(v)
        kinds = {"kept_sha256": pa.string(), "kept": pa.binary()}
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items())], names=["doc_id", *out])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_repeated and kept (bytes: a cut can fall inside a character)."""
    spark = docs.sparkSession
    _common.ship(spark)
    scratch = _common.Scratch(spark)
    docs = _common.columns(docs, doc_id="long", text="string").select(
        "doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("k1"), F.xxhash64("text").alias("k2"), "text"
    )
    stretch = scratch.keep(docs.mapInArrow(_map, STRETCH), "stretches")
    busy = scratch.keep(stretch.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("anchor"), "busy")
    every = scratch.keep(stretch.join(busy.hint("merge"), "anchor"), "every")
    scratch.drop(stretch, busy)
    scratch.free()
    distinct = every.groupBy("anchor", "e1", "e2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("k1", "k2", "lo", "hi", "x")).alias("at"))
    distinct = scratch.keep(distinct, "distinct")
    many = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    want = distinct.join(many.hint("merge"), "anchor").groupBy("at.k1", "at.k2").agg(F.collect_list(F.struct("anchor", "e1", "e2", "n", "m", "at.x", "at.lo", "at.hi")).alias("want"))
    pieces = docs.join(want.hint("merge"), ["k1", "k2"]).select("text", "want").mapInArrow(_cut, PIECE)
    pieces = scratch.keep(pieces, "pieces")
    scratch.free()
    few = pieces.filter(F.col("m") <= MAX_GROUP)
    few = _common.fan_out(few, ["anchor"]).sortWithinPartitions("anchor", "e1", "e2").mapInArrow(_compare, MATCHES)
    hot = pieces.filter(F.col("m") > MAX_GROUP).select("e1", "e2", "n", "x", "piece").dropDuplicates(["e1", "e2"])
    hot = scratch.keep(hot, "hot")
    cores = scratch.keep(hot.mapInArrow(lambda it: _windows(it, True), WINDOW), "cores")
    shared = cores.filter("whole").groupBy("w1", "w2", "t").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = scratch.keep(shared, "shared")  # a table of its own: Spark can split a join on a busy key
    ask = cores.hint("merge").join(shared.hint("merge"), ["w1", "w2", "t"], "left").filter("c > 1 or not whole").groupBy("e1", "e2").agg(F.collect_set(F.struct("size", "t")).alias("ts"))
    spots = scratch.keep(hot.join(ask.hint("merge"), ["e1", "e2"]).mapInArrow(lambda it: _windows(it, False), WINDOW), "windows")
    twice = scratch.keep(spots.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "twice")
    starts = [F.sort_array(F.collect_set(F.when(F.col("size") == n, F.col("t")))).alias(c) for n, c in ((LENGTH, "starts"), (SHORT, "near"))]
    wide = spots.hint("merge").join(twice.hint("merge"), ["w1", "w2"]).groupBy("e1", "e2").agg(*starts)
    wide = wide.select("e1", "e2", "starts", F.transform("starts", lambda s: s + LENGTH).alias("ends"), "near", F.transform("near", lambda s: s + SHORT).alias("far"))
    alone = few.unionByName(wide)
    size = F.col("at.hi") - F.col("at.lo")
    ends = {"starts": F.lit(0), "ends": size}
    copied = distinct.filter("n > 1").select(
        "e1", "e2", *(F.when(size >= LENGTH, F.array(v)).otherwise(F.array().cast("array<int>")).alias(c) for c, v in ends.items()), F.array(F.lit(0)).alias("near"), F.array(size).alias("far")
    )
    # a stretch that occurs twice goes whole; what the other two paths find about it is the same or less
    found = scratch.keep(copied.unionByName(alone.join(copied.select("e1", "e2").hint("merge"), ["e1", "e2"], "left_anti")), "found")
    marks = every.select("k1", "k2", "e1", "e2", "lo").join(found.hint("merge"), ["e1", "e2"]).groupBy("k1", "k2").agg(F.collect_list(F.struct("lo", "starts", "ends", "near", "far")).alias("found"))
    marks = scratch.keep(marks, "marks")
    scratch.close(marks)
    scratch.free()
    return docs.join(marks.hint("merge"), ["k1", "k2"], "left").select("doc_id", "text", "found").mapInArrow(
        _apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_repeated long, kept binary"
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_common.table(spark, sf_dir, "documents")).drop("kept")


QUERIES = {"op4_suffix_dedup": op4_suffix_dedup}
ORACLE: dict[str, str] = {}
