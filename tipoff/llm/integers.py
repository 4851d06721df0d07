"""Exact integer vectors for the operators on embeddings: floors of scaled components and sums of any size.

Components are 64-bit integers where no square or sum that an operator makes can leave 63 bits (from the table's largest magnitude),
and Python integers in object arrays otherwise: the same code serves both. Sums travel as limbs of LIMB bits (the last one with
the sign), which Spark adds as longs.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tipoff.llm import _common

LIMB = 31
#: A magnitude from which a component, scaled, no longer fits a double.
LARGEST = 2.0**1000


def usable(vecs: DataFrame, *more: str) -> DataFrame:
    """vec_id, v (doubles) and further columns (as text) of rows whose vector is not null and holds finite components only."""
    v = _common.columns(vecs, vec_id="long", embedding="array<double>", **dict.fromkeys(more, "string"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= LARGEST))
    return v.filter("embedding is not null").filter(~bad).filter(F.size("embedding") > 0).withColumnRenamed("embedding", "v")


def lengths(rows: DataFrame) -> list:
    """dim, n, top (largest magnitude) of each vector length, the most frequent first."""
    top = F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))
    return rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), top.alias("top")).orderBy(F.desc("n"), "dim").limit(1).collect()


def wide(top: float, scale: int, terms: int) -> bool:
    """Whether a sum of so many squared differences can pass 62 bits."""
    return (2 * (int(top) * scale + scale + 1)) ** 2 * terms >= 1 << 62


def floors(x: np.ndarray, scale: int, big: bool) -> np.ndarray:
    """floor(scale * x), exactly; scale is a power of two, so that the product is exact."""
    y = np.floor(x * scale)
    return np.array([int(z) for z in y.ravel()], object).reshape(y.shape) if big else y.astype(np.int64)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def longs(x: Iterable) -> pa.Array:
    """Integers as longs; null where one doesn't fit."""
    return pa.array(x, pa.int64()) if getattr(x, "dtype", None) != object else pa.array([int(v) if -(1 << 63) <= v < 1 << 63 else None for v in x], pa.int64())


def n_limbs(top: float, scale: int) -> int:
    """Limbs that hold a task's sum of 2**48 components."""
    return ((int(top) * scale + scale + 1).bit_length() + 48) // LIMB + 1


def limbs(x: np.ndarray, n: int) -> list[np.ndarray]:
    """The limbs of each integer, lowest first."""
    out = []
    for _ in range(n - 1):
        out.append((x & ((1 << LIMB) - 1)).astype(np.int64))
        x = x >> LIMB
    return [*out, x.astype(np.int64)]


def joined(parts: Iterable[int]) -> int:
    return sum(int(p) << (LIMB * k) for k, p in enumerate(parts))


def add_by(keys: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of each key 0 .. n - 1."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(keys):
        o = np.argsort(keys, kind="stable")
        k = keys[o]
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        out[k[first]] = np.add.reduceat(values[o], first, axis=0)
    return out


def total(column: str):
    """A sum of longs that can't overflow."""
    return F.sum(F.col(column).cast("decimal(38,0)"))


def as_long(value) -> int | None:
    """An exact integer as a long, or null if it doesn't fit."""
    return None if value is None or not -(1 << 63) <= int(value) < 1 << 63 else int(value)
