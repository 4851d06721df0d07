"""Sorted runs of 64-bit hashes, packed for shuffling and storage.

A map task sorts the hashes of about a million windows, keeps one entry for each hash (what several documents share inside
the chunk is settled there, so a hot hash costs one entry for each chunk, not one for each document), cuts the run at fixed
hash ranges (buckets) and packs each piece. Sorted hashes are stored as differences in byte planes, which takes 5 to 6
bytes an entry.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries gathered before a run is sorted, and bytes of text for each bucket: a bucket fits in a task's memory at any corpus size.
CHUNK, BUCKET_BYTES = 1 << 20, 8 << 20
PIECE = "bucket int, kind int, docs binary, hashes binary, who binary"


def pack(x: np.ndarray) -> bytes:
    """An integer array as compressed byte planes."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(b: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def pack_sorted(h: np.ndarray) -> bytes:
    return pack(np.diff(h, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, np.uint64), dtype=np.uint64)


def n_buckets(docs: DataFrame) -> int:
    """Buckets for a table, from the bytes of its texts."""
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).collect()[0][0] or 0
    return max(1, -(-size // BUCKET_BYTES))


def bucket_limits(h: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket starts in sorted hashes: buckets split the hash range evenly."""
    edges = [(k << 64) // buckets for k in range(1, buckets)]
    return np.r_[0, np.searchsorted(h, np.array(edges, np.uint64)), len(h)].astype(np.int64)


def pieces(h: np.ndarray, docs: np.ndarray, mark: np.ndarray, buckets: int):
    """(bucket, docs, hashes, who) of a sorted run; who is the entry's place among the piece's documents, times two, plus its mark."""
    lim = bucket_limits(h, buckets)
    for b in np.flatnonzero(np.diff(lim)):
        part = slice(lim[b], lim[b + 1])
        ids, who = np.unique(docs[part], return_inverse=True)
        who = who * 2 + mark[part]
        yield int(b), pack(ids), pack_sorted(h[part]), pack(who.astype(np.uint16 if len(ids) < 1 << 15 else np.uint32))


def entries(docs: bytes, hashes: bytes, who: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, documents and marks of a packed piece."""
    ids, h = unpack(docs, np.int64), unpack_sorted(hashes)
    w = unpack(who, np.uint16 if len(ids) < 1 << 15 else np.uint32).astype(np.int64)
    return h, ids[w >> 1], w & 1


def groups_of(buckets: int) -> int:
    """Groups of documents: the first prime from the number of buckets on, so that regular ids spread evenly."""
    n = max(buckets, 2)
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n
