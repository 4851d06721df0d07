"""SentencePiece encoding by sampling, and decoding.

A text's piece lattice has an edge for every vocabulary piece that matches its bytes, and costlier single-byte edges so
that any text can be encoded. Forward filtering sums the weights of all paths to each position; backward sampling then
draws a path from its end. Draws come from a hash of the row key, the position and the seed, so a row's segmentation is
the same on every run and executor. No piece crosses the start of a run of spaces or a line feed, so the lattice falls into
units that are filtered once per distinct unit. A long unit (a text without spaces) is filtered by itself, in time that is
linear in its length and with a number held for each position; texts of any length are encoded whole.

The public model file stores merge ranks, not probabilities: a piece of rank r weighs 1 / (r + RANK_OFFSET), to the power
1 / temperature. Decoding joins the pieces' bytes ('▁' is a space; a literal '▁' is kept as byte pieces), so it returns the
exact text; the encoder verifies that for each row.

Defined results: null and empty texts have no pieces and are lossless (a null text decodes to an empty one); rows with one
key and one text get one segmentation; a null key counts as 0; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tipoff.llm import _common, _text
from tipoff.llm._text import MASK, U64, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RANK_OFFSET, TEMPERATURE, BYTE_COST, SEED, SLOT_BITS = 10.0, 1.0, 25.0, 1, 20
#: Bytes of text handled at a time, and of its distinct units' lattices.
TEXT_BYTES, LATTICE_BYTES = 1 << 20, 1 << 17
#: Bytes from which a unit (text without spaces) is filtered by itself, and positions of it whose edges are held.
LONG, LONG_STEP = 256, 1 << 15
TABLE, BASE = _text.byte_table(11), 0xD1342543DE82EF95


class Pieces:
    """The vocabulary as hash tables by piece length in bytes."""

    def __init__(self, model: bytes, temperature: float = TEMPERATURE) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.raw, self.byte_id = [b""] * n, np.zeros(256, np.int64)
        by_len: dict[int, list[tuple[bytes, int, float]]] = {}
        seen = set()
        for i in range(n):
            if sp.is_byte(i):
                self.raw[i] = bytes([int(sp.id_to_piece(i)[3:5], 16)])
                self.byte_id[self.raw[i][0]] = i
            elif not (sp.is_control(i) or sp.is_unknown(i)):
                b = sp.id_to_piece(i).replace("▁", " ").encode()
                self.raw[i] = b
                if b and b not in seen and b"\n" not in b:
                    seen.add(b)
                    by_len.setdefault(len(b), []).append((b, i, min(-sp.get_score(i), float(n))))
        z = np.log(sum(1 / (r + RANK_OFFSET) for x in by_len.values() for _, _, r in x))
        self.sizes, hashes, ids, ranks = sorted(by_len, reverse=True), [], [], []
        for ln, x in by_len.items():
            data = np.frombuffer(b"".join(b for b, _, _ in x), np.uint8)
            hashes.append((TABLE[data].reshape(-1, ln) * _text.powers(BASE, ln)).sum(1, dtype=U64) + U64(ln))
            ids += [i for _, i, _ in x]
            ranks += [r for _, _, r in x]
        self.hash, self.ids = np.concatenate(hashes), np.array(ids)
        self.weight = -(np.log(np.array(ranks) + RANK_OFFSET) + z) / temperature
        self.slots = np.full((1 << SLOT_BITS) + 64, -1, np.int32)
        for k, at in enumerate(self.slot(self.hash).tolist()):
            while self.slots[at] >= 0:
                at += 1
            self.slots[at] = k
        self.lengths = np.array([len(b) for b in self.raw])
        self.bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.joined_inside = any(b" " in b.lstrip(b" ") for b in seen)

    @staticmethod
    def slot(h: np.ndarray) -> np.ndarray:
        return ((h * U64(0x9E3779B97F4A7C15)) >> U64(64 - SLOT_BITS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The piece number of each hash, -1 for none: open addressing, a free slot ends the search."""
        out, at, todo = np.full(len(h), -1, np.int64), self.slot(h), np.arange(len(h))
        while len(todo):
            k = self.slots[at[todo]]
            held = k >= 0
            todo, k = todo[held], k[held]
            same = self.hash[k] == h[todo]
            out[todo[same]] = k[same]
            todo = todo[~same]
            at[todo] += 1
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that the pieces stand for."""
        ln = self.lengths[ids]
        at = np.arange(int(ln.sum())) - np.repeat(np.cumsum(ln) - ln, ln)
        return self.bytes[np.repeat(self.first[ids], ln) + at]


def units(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Starts of the lattice's independent stretches: texts, runs of spaces, and line feeds on their own."""
    n = len(data)
    start = np.zeros(n + 1, bool)
    start[offs] = True
    space, feed = data == 0x20, data == 0x0A
    start[:n] |= feed
    start[1:] |= feed
    start[1:n] |= space[1:] & ~space[:-1]
    return np.flatnonzero(start[:n])


def edges(flat: np.ndarray, j: np.ndarray, vocab: Pieces, skip: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """End byte, length, piece id and log weight of every edge that ends at byte `skip` or later; j: position in its unit after each byte."""
    n = len(flat)
    s = np.r_[U64(0), np.cumsum(TABLE[flat] * _text.powers(BASE, n), dtype=U64)]
    back = _text.powers(pow(BASE, -1, 1 << 64), n + 1)
    ends, lens, ids, ws = [], [], [], []
    for ln in vocab.sizes:
        e = np.flatnonzero(j[skip:] >= ln) + skip
        k = vocab.find((s[e + 1] - s[e + 1 - ln]) * back[e + 1 - ln] + U64(ln))
        hit = k >= 0
        k = k[hit]
        ends.append(e[hit].astype(np.int32))
        lens.append(np.full(len(k), ln, np.int16))
        ids.append(vocab.ids[k].astype(np.int32))
        ws.append(vocab.weight[k])
    ends.append(np.arange(skip, n, dtype=np.int32))
    lens.append(np.ones(n - skip, np.int16))
    ids.append(vocab.byte_id[flat[skip:]].astype(np.int32))
    ws.append(np.full(n - skip, -BYTE_COST))
    return tuple(np.concatenate(x) for x in (ends, lens, ids, ws))


def lattice(flat: np.ndarray, first: np.ndarray, size: np.ndarray, vocab: Pieces) -> tuple:
    """Edges of distinct short units by end position, with the cumulative probability of each as the last step to it.

    flat: the units' bytes; nodes are numbered first[u] + u + j for position j of unit u.
    """
    n, unit = len(flat), np.repeat(np.arange(len(first)), size)
    j = np.arange(n) - np.repeat(first, size) + 1  # position after the byte
    end, ln, pid, w = edges(flat, j, vocab)
    order = np.lexsort((end, j[end]))  # by position in the unit, then by node
    end, ln, pid, w = end[order], ln[order], pid[order], w[order]
    node = end + unit[end] + 1
    alpha, cum = np.full(n + len(first), -np.inf), np.zeros(len(end))
    alpha[first + np.arange(len(first))] = 0.0
    lim = np.searchsorted(j[end], np.arange(1, int(size.max(initial=0)) + 2))
    for a, b in zip(lim[:-1], lim[1:], strict=True):
        v = alpha[node[a:b] - ln[a:b]] + w[a:b]
        new = np.flatnonzero(np.r_[True, node[a + 1 : b] != node[a : b - 1]])
        sizes = np.diff(np.r_[new, b - a])
        top = np.maximum.reduceat(v, new)
        p = np.exp(v - np.repeat(top, sizes))
        total = np.add.reduceat(p, new)
        alpha[node[a:b][new]] = top + np.log(total)
        c = np.cumsum(p)
        c -= np.repeat(np.r_[0.0, c[new[1:] - 1]], sizes)
        cum[a:b] = c / np.repeat(total, sizes)
    new = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    last = np.r_[new[1:], len(node)] - 1
    cum[last] = np.inf
    begin = np.zeros(n + len(first), np.int32)
    begin[node[new]] = new
    return cum, begin, ln, pid


def lattices(data: np.ndarray, st: np.ndarray, size: np.ndarray, vocab: Pieces) -> tuple:
    """lattice() of units that start at st, about LATTICE_BYTES of them at a time: only what the draws need is held for all."""
    first = np.cumsum(size) - size
    parts, n_edges = [], 0
    cut = np.r_[np.flatnonzero(np.r_[True, np.diff(first // LATTICE_BYTES) > 0]), len(st)] if len(st) else np.zeros(1, np.int64)
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        f = first[a:b] - first[a]
        flat = data[np.repeat(st[a:b] - f, size[a:b]) + np.arange(int(size[a:b].sum()))]
        cum, begin, ln, pid = lattice(flat, f, size[a:b], vocab)
        parts.append((cum, begin + np.int32(n_edges), ln, pid))
        n_edges += len(cum)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0), *(np.zeros(0, np.int32) for _ in range(3)))


def steps_to(unit: np.ndarray, a: int, b: int, vocab: Pieces) -> list[list[tuple[int, float, int]]]:
    """(length, log weight, piece) of the edges to each position a + 1 .. b of a unit."""
    lo = max(0, a - vocab.sizes[0])
    end, ln, pid, w = edges(unit[lo:b], np.arange(lo + 1, b + 1), vocab, a - lo)
    order = np.argsort(end, kind="stable")
    lim = np.searchsorted(end[order], np.arange(a - lo, b - lo + 1)).tolist()
    every = list(zip(ln[order].tolist(), w[order].tolist(), pid[order].tolist(), strict=True))
    return [every[x:z] for x, z in zip(lim[:-1], lim[1:], strict=True)]


def draw_long(unit: np.ndarray, salts: list[tuple[int, int]], vocab: Pieces, out: np.ndarray) -> None:
    """Forward filtering of one long unit, a position at a time, and a draw for each of its places (start in the slice, salt).

    Edges are made again, a stretch at a time, for the draws: beside the bytes only one number for each position is held.
    """
    n, exp, log = len(unit), math.exp, math.log
    alpha = [0.0]
    for a in range(0, n, LONG_STEP):
        p = a
        for step in steps_to(unit, a, min(n, a + LONG_STEP), vocab):
            p += 1
            v = [alpha[p - ln] + w for ln, w, _ in step]
            top = max(v)
            alpha.append(top + log(sum([exp(x - top) for x in v])))
    at = [n] * len(salts)
    for a in range((n - 1) // LONG_STEP * LONG_STEP, -1, -LONG_STEP):
        b = min(n, a + LONG_STEP)
        steps = steps_to(unit, a, b, vocab)
        for k, (start, salt) in enumerate(salts):
            u = uniform(U64(salt) + (np.arange(a + 1, b + 1).astype(U64) + U64(start)) * U64(0x9E3779B97F4A7C15)).tolist()
            p = at[k]
            while p > a:
                step, here = steps[p - a - 1], alpha[p]
                left, last = u[p - a - 1], step[-1]
                for e in step:
                    left -= exp(alpha[p - e[0]] + e[1] - here)
                    if left < 0:
                        last = e
                        break
                p -= last[0]
                out[start + p] = last[2]
            at[k] = p


def uniform(x: np.ndarray) -> np.ndarray:
    return (mix(x) >> U64(11)).astype(np.float64) / float(1 << 53)


def sample(data: np.ndarray, offs: np.ndarray, keys: np.ndarray, vocab: Pieces, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all texts in order, and the count of each text."""
    if len(data) == 0:
        return np.zeros(0, np.int32), np.zeros(len(offs) - 1, np.int64)
    st = units(data, offs)
    en = np.r_[st[1:], len(data)]
    row = np.searchsorted(offs, st, "right") - 1
    salt = mix(keys.astype(np.int64).view(U64), seed)[row] - offs[row].astype(U64) * U64(0x9E3779B97F4A7C15 & MASK)
    out = np.full(len(data), -1, np.int32)
    short = np.flatnonzero(en - st <= LONG)
    _, at, which = np.unique(_text.word_hashes(data, st[short], en[short], TABLE, BASE | 2), return_index=True, return_inverse=True)
    size = (en - st)[short[at]]
    cum, begin, ln, pid = lattices(data, st[short[at]], size, vocab)
    root = (np.cumsum(size) - size + np.arange(len(size)))[which]
    salts, pos = salt[short], en[short]
    node, live = root + (en - st)[short], np.arange(len(short))
    while len(live):
        u = uniform(salts[live] + pos[live].astype(U64) * U64(0x9E3779B97F4A7C15))
        edge = begin[node[live]]
        below = np.flatnonzero(cum[edge] <= u)
        while len(below):
            edge[below] += 1
            below = below[cum[edge[below]] <= u[below]]
        node[live] -= ln[edge]
        pos[live] -= ln[edge]
        out[pos[live]] = pid[edge]
        live = live[node[live] > root[live]]
    same: dict[bytes, list[int]] = {}
    for k in np.flatnonzero(en - st > LONG).tolist():
        same.setdefault(data[st[k] : en[k]].tobytes(), []).append(k)
    for raw, places in same.items():
        draw_long(np.frombuffer(raw, np.uint8), [(int(st[k]), int(salt[k])) for k in places], vocab, out)
    placed = out >= 0
    return out[placed], np.diff(np.r_[0, np.cumsum(placed)][offs])


@_common.tidy
def _encode(batches: Iterator[pa.RecordBatch], model: bytes, key: str, temperature: float, seed: int, digest: bool) -> Iterator[pa.RecordBatch]:
    vocab = Pieces(model, temperature)
    for b in batches:
        for i, j, data, offs in _text.slices(b, "text", TEXT_BYTES):
            part = b.slice(i, j - i)
            keys = part.column(key).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            ids, n = sample(data, offs, keys, vocab, seed)
            back = vocab.decode(ids)
            same = np.r_[0, np.cumsum(back == data)] if len(back) == len(data) else np.zeros(len(data) + 1, np.int64)
            ids, lim = ids.astype("<i4"), np.r_[0, np.cumsum(n)]
            lists = pa.ListArray.from_arrays(pa.array(lim.astype(np.int32)), pa.array(ids, pa.int32()))
            extra = [pa.array(n), pa.array(same[offs[1:]] - same[offs[:-1]] == np.diff(offs)), lists]
            names = ["n_pieces", "lossless", "pieces"]
            if digest:
                shas = [hashlib.sha256(ids[x:z].tobytes()).hexdigest() for x, z in zip(lim[:-1], lim[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(np.diff(offs)), *extra, pa.array(shas, pa.string())], names=[key, "n_bytes", *names, "pieces_sha256"])
            else:
                yield pa.RecordBatch.from_arrays([*part.columns, *extra], names=[*part.schema.names, *names])


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, path: str = MODEL, temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """The documents with n_pieces, lossless and pieces (ids); columns of those names are replaced."""
    _common.ship(docs.sparkSession)
    model = read_model(path)  # the driver's file: half a megabyte, sent with the code
    docs = docs.drop("n_pieces", "lossless", "pieces")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", n_pieces long, lossless boolean, pieces array<int>"
    return docs.mapInArrow(lambda it: _encode(it, model, "doc_id", temperature, seed, False), schema)


@_common.tidy
def _decode(batches: Iterator[pa.RecordBatch], model: bytes) -> Iterator[pa.RecordBatch]:
    vocab = Pieces(model)
    for b in batches:
        text = [vocab.decode(np.asarray(x or [], np.int64)).tobytes().decode() for x in b.column("pieces").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(text, pa.string())], names=["doc_id", "text"])


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """doc_id and the text that its pieces stand for."""
    _common.ship(encoded.sparkSession)
    model = read_model(path)
    return _common.columns(encoded, doc_id="long", pieces="array<int>").mapInArrow(lambda it: _decode(it, model), "doc_id long, text string")


def op1_piece_sampling(spark: SparkSession, sf_dir: str, path: str = MODEL) -> DataFrame:
    docs = _common.columns(_common.table(spark, sf_dir, "documents"), doc_id="long", text="string")
    _common.ship(spark)
    model = read_model(path)
    return docs.mapInArrow(lambda it: _encode(it, model, "doc_id", TEMPERATURE, SEED, True), "doc_id long, n_bytes long, n_pieces long, lossless boolean, pieces array<int>, pieces_sha256 string")


QUERIES = {"op1_piece_sampling": op1_piece_sampling}
ORACLE: dict[str, str] = {}
