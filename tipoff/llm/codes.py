"""Vector codes: product quantisation in whole numbers, with early elimination in the Walsh-Hadamard domain.

A vector's components become integers floor(SCALE * x) and are cut into PARTS equal parts, each with a codebook of ENTRIES entries.
To find a part's nearest entry, parts and entries are filled with zeros to a power of two and go through the integer
Walsh-Hadamard transform; its coefficients, in sequency order (smooth ones first), hold the same distances times the padded
length. Squared differences are added coefficient by coefficient, and an entry goes as soon as its sum passes the whole
distance of a first guess, which bounds the least one. No floating point takes part after the floors, so distances, ties
(to the lower index) and sums are exact.

Each round is one scan: a task assigns its parts, adds them up by entry, and sends one row for each entry that it used. The driver
holds the codebooks (PARTS x ENTRIES entries), nothing that grows with the table.

Defined results: rows take part if their vector is not null and holds neither null nor non-finite components (nor ones of 2**1000 or
more), and has the table's most frequent length (ties: the smaller); lengths that PARTS doesn't divide are filled with zeros.
Repeated rows and vec_ids are coded each; rows without vec_id are coded, but start no entry before those that have one (ties at the
start go to the smaller vector). With fewer rows than ENTRIES codebooks are shorter; an empty table gives an empty result. An error that doesn't
fit a long is null. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tipoff.llm import _common, integers

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Parts that are compared together.
TOGETHER = 4096


def sequency(n: int) -> np.ndarray:
    """Rows of the natural Walsh-Hadamard matrix of size n by their sign changes."""
    i, j = np.arange(n)[:, None], np.arange(n)
    sign = np.bitwise_count(i & j) & 1
    return np.argsort((sign[:, 1:] != sign[:, :-1]).sum(1), kind="stable")


def transform(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row, filled with zeros to a power of two, in sequency order."""
    n = 1 << (x.shape[1] - 1).bit_length()
    y = np.zeros((len(x), n), x.dtype)
    y[:, : x.shape[1]] = x
    half = 1
    while half < n:
        z = y.reshape(len(x), -1, 2, half)
        y = np.stack([z[:, :, 0] + z[:, :, 1], z[:, :, 0] - z[:, :, 1]], 2).reshape(len(x), n)
        half *= 2
    return y[:, sequency(n)]


def nearest(a: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For transformed parts and entries: each part's nearest entry (ties: the lowest), its squared distance, and the squared differences that were added."""
    n = a.shape[1]
    first = (a[:, :1] - c[:, 0]) ** 2
    guess = first.argmin(1)
    bound = ((a - c[guess]) ** 2).sum(1)
    row, entry = np.nonzero(first <= bound[:, None])
    so_far, added = first[row, entry], np.full(len(a), len(c) + n)
    for s in range(1, n):
        so_far = so_far + (a[row, s] - c[entry, s]) ** 2
        added += np.bincount(row, minlength=len(a))
        stay = (so_far <= bound[row]).astype(bool)
        row, entry, so_far = row[stay], entry[stay], so_far[stay]
    start = np.searchsorted(row, np.arange(len(a)))  # each part keeps its guess at least
    least = np.minimum.reduceat(so_far, start) if len(a) else so_far
    at = np.flatnonzero((so_far == least[row]).astype(bool))
    at = at[np.r_[True, row[at][1:] != row[at][:-1]]] if len(at) else at
    return entry[at], least // n, added


@dataclass
class Books:
    """The codebooks (part, entry, position within part) and what makes parts of vectors."""

    entries: np.ndarray
    dim: int
    scale: int
    big: bool

    def cut(self, column: pa.Array) -> np.ndarray:
        """Parts of vectors: vector, part, position."""
        parts, _, width = self.entries.shape
        x = integers.floors(integers.matrix(column, self.dim), self.scale, self.big)
        if self.dim < parts * width:
            x = np.c_[x, np.zeros((len(x), parts * width - self.dim), x.dtype)]
        return x.reshape(len(x), parts, width)

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entry, squared distance and added terms of every part."""
        out = [np.zeros(x.shape[:2], np.int64), np.zeros(x.shape[:2], x.dtype), np.zeros(x.shape[:2], np.int64)]
        for p in range(x.shape[1]):
            c = transform(self.entries[p])
            for i in range(0, len(x), TOGETHER):
                for o, y in zip(out, nearest(transform(x[i : i + TOGETHER, p]), c), strict=True):
                    o[i : i + TOGETHER, p] = y
        return tuple(out)

    def digest(self) -> str:
        """Lowercase sha256 of all components in order."""
        return hashlib.sha256(",".join(str(int(c)) for c in self.entries.ravel()).encode()).hexdigest()


@_common.tidy
def _sums(batches: Iterator[pa.RecordBatch], books: Books, limbs: int) -> Iterator[pa.RecordBatch]:
    """Number and sum of the parts at each entry, over a task's vectors."""
    parts, k, width = books.entries.shape
    n, sums = np.zeros(parts * k, np.int64), np.zeros((parts * k, width), books.entries.dtype)
    for b in batches:
        x = books.cut(b.column("v"))
        entry, _, _ = books.assign(x)
        key = (entry + np.arange(parts) * k).ravel()
        n += np.bincount(key, minlength=parts * k)
        sums = sums + integers.add_by(key, x.reshape(-1, width), parts * k)
    used = np.flatnonzero(n)
    cols = [pa.array(z) for c in range(width) for z in integers.limbs(sums[used, c], limbs)]
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used]), *cols], names=["entry", "n", *(f"s{i}" for i in range(len(cols)))])


def train(vecs: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Books | None:
    """Codebooks of whole numbers, started from the smallest vec_ids; None without a usable vector."""
    spark = vecs.sparkSession
    _common.ship(spark)
    rows = integers.usable(vecs)
    found = integers.lengths(rows)
    if not found:
        return None
    dim, _, top = found[0]
    rows = rows.filter(F.size("v") == dim)
    width = -(-dim // parts)
    big = integers.wide(top, scale, (1 << (width - 1).bit_length()) ** 3 * parts)
    limbs = integers.n_limbs(top, scale)
    first = np.array([r.v for r in rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()], float)
    books = Books(np.zeros((parts, 1, width), object if big else np.int64), dim, scale, big)
    books.entries = np.ascontiguousarray(books.cut(pa.array(list(first), pa.list_(pa.float64()))).transpose(1, 0, 2))
    names = [f"s{i}" for i in range(width * limbs)]
    for _ in range(rounds):
        sums = rows.select("v").mapInArrow(lambda it, x=books: _sums(it, x, limbs), "entry long, n long, " + ", ".join(f"{c} long" for c in names))
        flat = books.entries.reshape(-1, width).copy()
        for r in sums.groupBy("entry").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in names)).collect():  # a row for each entry of the codebooks
            flat[r.entry] = [integers.joined(r[2 + c * limbs : 2 + (c + 1) * limbs]) // r.n for c in range(width)]
        books = Books(flat.reshape(books.entries.shape), dim, scale, big)
    return books


@_common.tidy
def _codes(batches: Iterator[pa.RecordBatch], books: Books) -> Iterator[pa.RecordBatch]:
    hexes = np.array([f"{k:02x}" for k in range(books.entries.shape[1])], object)
    for b in batches:
        entry, d, added = books.assign(books.cut(b.column("v")))
        code = ["".join(x) for x in hexes[entry]]
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(code, pa.string()), integers.longs(d.sum(1)), pa.array(added.sum(1))], names=["vec_id", "label", "code", "error", "terms"])


def encode(vecs: DataFrame, books: Books) -> DataFrame:
    """vec_id, label, code (an entry's index for each part, two hexadecimal digits), error (squared distance) and terms (squared differences added) of each usable vector."""
    rows = integers.usable(vecs, "label").filter(F.size("v") == books.dim)
    return rows.mapInArrow(lambda it: _codes(it, books), "vec_id long, label string, code string, error long, terms long")


def decode(codes: DataFrame, books: Books) -> DataFrame:
    """vec_id and the vector (doubles) that each code stands for: its entries' components over the scale."""
    table = books.entries

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.array([list(bytes.fromhex(c)) for c in b.column("code").to_pylist()], np.int64).reshape(-1, len(table))
            v = np.concatenate([table[p][at[:, p]] for p in range(len(table))], 1)[:, : books.dim].astype(float) / books.scale
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(list(v), pa.list_(pa.float64()))], names=["vec_id", "vector"])

    return codes.select("vec_id", "code").mapInArrow(rows, "vec_id long, vector array<double>")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns. The sums by label are written, so that Spark knows their size when it picks the join."""
    vecs, scratch = _common.table(spark, sf_dir, "embeddings"), _common.Scratch(spark)
    books = train(vecs)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    codes = scratch.keep(encode(vecs, books), "codes")
    sums = scratch.keep(codes.groupBy("label").agg(integers.total("error").alias("s")).select(F.col("label").alias("l"), F.expr("try_cast(s as bigint)").alias("label_error")), "sums")
    return codes.join(sums, codes["label"].eqNullSafe(sums["l"]), "left").select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def _sql() -> str:
    """The same rounds as relations: a row for each vector, part and position."""
    steps = [
        "k AS MATERIALIZED (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS rank, embedding AS v FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"x AS MATERIALIZED (SELECT vec_id, label, rank, CAST((i - 1) // (len(v) // {PARTS}) AS BIGINT) AS part, i - 1 AS pos, CAST(floor({SCALE} * CAST(v[i] AS DOUBLE)) AS BIGINT) AS c FROM k, unnest(range(1, len(v) + 1)) AS u(i))",
        f"b0 AS MATERIALIZED (SELECT part, rank - 1 AS entry, pos, c FROM x WHERE rank <= {ENTRIES})",
    ]
    for r in range(ROUNDS + 1):
        steps.append(f"a{r} AS MATERIALIZED (SELECT vec_id, part, entry, d FROM (SELECT x.vec_id, x.part, b.entry, sum((x.c - b.c) * (x.c - b.c)) AS d FROM x JOIN b{r} AS b ON x.part = b.part AND x.pos = b.pos GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1)")
        if r < ROUNDS:
            steps.append(f"m{r} AS (SELECT x.part, entry, pos, sum(x.c) AS s, count(*) AS n FROM x JOIN a{r} AS a ON x.vec_id = a.vec_id AND x.part = a.part GROUP BY ALL)")
            steps.append(f"b{r + 1} AS MATERIALIZED (SELECT part, entry, pos, CAST(coalesce((s - ((s % n) + n) % n) // n, c) AS BIGINT) AS c FROM b{r} LEFT JOIN m{r} USING (part, entry, pos))")
    steps.append(f"e AS MATERIALIZED (SELECT vec_id, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id)")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b{ROUNDS}) AS codebooks_sha256
FROM e JOIN k USING (vec_id)"""


QUERIES = {"op11_vector_codes": op11_vector_codes}
ORACLE: dict[str, str] = {"op11_vector_codes": _sql()}
